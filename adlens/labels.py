"""Text values that must equal the reference's, in one place.

Fixed values (as the reference writes them): the keys of the report
datasets by chart type, the media names used in them, default names, the
week label and display date formats, and the report time zone.
"""

# ---- fixed values -------------------------------------------------------
# pie dataset
KEY_MEDIA = "매체"
KEY_COST = "광고비(원)"
# line dataset
KEY_DATE = "날짜"
KEY_GOOGLE_COST = "구글 광고비(원)"
KEY_KAKAO_COST = "카카오 광고비(원)"
# bar dataset
KEY_CAMPAIGN = "캠페인명"
KEY_IMPRESSIONS = "노출수"
KEY_CLICKS = "클릭수"
KEY_CONVERSIONS = "전환수"
KEY_CONV_VALUE = "전환가치(원)"
# table dataset (besides the date and the two costs)
KEY_GOOGLE_IMPRESSIONS = "구글 노출"
KEY_GOOGLE_CLICKS = "구글 클릭"
KEY_KAKAO_IMPRESSIONS = "카카오 노출"
KEY_KAKAO_CLICKS = "카카오 클릭"
# media names in datasets
MEDIA_GOOGLE = "구글"
MEDIA_KAKAO = "카카오"
# defaults
UNNAMED_CAMPAIGN = "(미분류)"
DEFAULT_MEDIA_PREFIX = "매체"            # followed by the 1-based row number
EMPTY_WEEK_LABELS = ["W1", "W2", "W3", "W4", "W5"]
WEEK_FALLBACK = "기타"
# week label "M월 N주차" and display date "YYYY년 MM월 DD일"
WEEK_MONTH_SUFFIX = "월 "
WEEK_SUFFIX = "주차"
DISPLAY_DATE_PATTERN = "yyyy'년' MM'월' dd'일'"
DATE_TEXT_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
DEFAULT_TZ = "Asia/Seoul"
# ---- end of fixed values ------------------------------------------------

MEDIA_IDS = {MEDIA_GOOGLE: "google", MEDIA_KAKAO: "kakao"}
LINE_KEYS = {"google_cost": KEY_GOOGLE_COST, "kakao_cost": KEY_KAKAO_COST}
TABLE_KEYS = {"google_cost": KEY_GOOGLE_COST, "kakao_cost": KEY_KAKAO_COST,
              "google_impressions": KEY_GOOGLE_IMPRESSIONS, "google_clicks": KEY_GOOGLE_CLICKS,
              "kakao_impressions": KEY_KAKAO_IMPRESSIONS, "kakao_clicks": KEY_KAKAO_CLICKS}
BAR_KEYS = {"impressions": KEY_IMPRESSIONS, "clicks": KEY_CLICKS, "cost": KEY_COST,
            "conversions": KEY_CONVERSIONS, "conv_value": KEY_CONV_VALUE}

"""Explicit schemas: the two fact tables, landed responses, queue messages
and report documents. Tables are always read with these (never inferred:
inference turns ``month_p=03`` into the integer 3)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D = T.StringType(), T.LongType(), T.DoubleType()

# The column lists of the two fact tables.
GOOGLE_STRINGS = [
    "camp_id", "camp_name", "camp_advertising_channel_type", "camp_status", "agroup_id", "agroup_name",
    "agroup_type", "creation_id", "creation_name", "creation_type", "creation_status", "creation_final_urls",
    "keyword_id", "keyword_text", "keyword_match_type", "device", "network_type", "basic_date", "adv_id",
    "date", "quarter", "day_of_week", "week"]
GOOGLE_LONGS = ["impressions", "clicks", "video_views", "all_conversions", "conversions"]
GOOGLE_DOUBLES = [
    "cost_micros", "ctr", "average_cpc", "all_conversions_value", "conversions_value", "value_per_conversion",
    "cost_per_conversion", "conversions_from_interactions_rate", "video_quartile_p25_rate",
    "video_quartile_p50_rate", "video_quartile_p75_rate", "video_quartile_p100_rate"]
KAKAO_STRINGS = [
    "kwd_id", "kwd_name", "kwd_config", "kwd_url", "kwd_bid_type", "agroup_id", "agroup_name", "camp_id",
    "camp_name", "camp_type", "biz_id", "biz_name", "lu_pc", "lu_mobile", "basic_date", "adv_id"]
KAKAO_LONGS = [
    "kwd_bid_amount", "imp", "click", "rimp", "rank", "conv_cmpt_reg_1d", "conv_cmpt_reg_7d",
    "conv_view_cart_1d", "conv_view_cart_7d", "conv_purchase_1d", "conv_purchase_7d",
    "conv_participation_1d", "conv_participation_7d", "conv_signup_1d", "conv_signup_7d",
    "conv_app_install_1d", "conv_app_install_7d"]
KAKAO_DOUBLES = ["spending", "ctr", "ppc", "conv_purchase_p_1d", "conv_purchase_p_7d"]
PARTITION_COLUMNS = ["year", "month_p", "day"]
# End of fixed values.


def _struct(strings, longs, doubles, partitions=True) -> T.StructType:
    f = ([T.StructField(c, S) for c in strings] + [T.StructField(c, L) for c in longs]
         + [T.StructField(c, D) for c in doubles])
    if partitions:
        # ours: the one date of a row, which its partition is made from
        f += [T.StructField("report_date", T.DateType())] + [T.StructField(c, S) for c in PARTITION_COLUMNS]
    return T.StructType(f)


GOOGLE_TABLE = _struct(GOOGLE_STRINGS, GOOGLE_LONGS, GOOGLE_DOUBLES)
KAKAO_TABLE = _struct(KAKAO_STRINGS, KAKAO_LONGS, KAKAO_DOUBLES)
TABLES = {"google_ad_performance": GOOGLE_TABLE, "kakao_ad_performance": KAKAO_TABLE}


def all_text(columns) -> T.StructType:
    return T.StructType([T.StructField(c, S) for c in columns])


# Landed google response: results[] of nested campaign / adGroup / keyword /
# segments / metrics objects (numbers may arrive as text).
_G_METRICS = ["impressions", "clicks", "videoViews", "allConversions", "conversions", "costMicros", "ctr",
              "averageCpc", "allConversionsValue", "conversionsValue", "valuePerConversion",
              "costPerConversion", "conversionsFromInteractionsRate", "videoQuartileP25Rate",
              "videoQuartileP50Rate", "videoQuartileP75Rate", "videoQuartileP100Rate"]
GOOGLE_RESPONSE = T.StructType([T.StructField("results", T.ArrayType(T.StructType([
    T.StructField("campaign", T.StructType([T.StructField(c, S) for c in
                                            ["id", "name", "advertisingChannelType", "status"]])),
    T.StructField("adGroup", T.StructType([T.StructField(c, S) for c in ["id", "name", "type"]])),
    T.StructField("adGroupCriterion", T.StructType([
        T.StructField("criterionId", S),
        T.StructField("keyword", T.StructType([T.StructField("text", S), T.StructField("matchType", S)]))])),
    T.StructField("segments", T.StructType([T.StructField(c, S) for c in
                                            ["device", "network", "date", "quarter", "dayOfWeek", "week"]])),
    T.StructField("metrics", T.StructType([T.StructField(c, S) for c in _G_METRICS])),
])))])

_K_METRICS = ["imp", "click", "spending", "ctr", "rimp", "ppc", "rank", "convCmptReg1d", "convCmptReg7d",
              "convViewCart1d", "convViewCart7d", "convPurchase1d", "convPurchase7d", "convPurchaseP1d",
              "convPurchaseP7d", "convParticipation1d", "convParticipation7d", "convSignup1d", "convSignup7d",
              "convAppInstall1d", "convAppInstall7d"]
KAKAO_RESPONSE = T.StructType([
    T.StructField("account_id", S),
    T.StructField("date", S),
    T.StructField("ok", T.BooleanType()),
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("keywordId", S), T.StructField("adGroupId", S),
        T.StructField("metrics", T.StructType([T.StructField(c, S) for c in _K_METRICS]))]))),
])
ACCOUNT_LIST = T.StructType([T.StructField("adAccounts", T.ArrayType(T.StructType([T.StructField("id", S)])))])

QUEUE_MESSAGE = T.StructType([
    T.StructField("message_id", S), T.StructField("body", S),
    T.StructField("attributes", T.StructType([
        T.StructField("ApproximateReceiveCount", S), T.StructField("SentTimestamp", S),
        T.StructField("ApproximateFirstReceiveTimestamp", S)]))])

#: One delivery of a queue message to a job, and whether the job succeeded.
DELIVERY = T.StructType([
    T.StructField("message_id", S), T.StructField("body", S), T.StructField("receipt", S),
    T.StructField("received_ms", T.LongType()), T.StructField("ok", T.BooleanType())])

REPORT_DOCUMENT = T.StructType([
    T.StructField("title", S), T.StructField("createdAt", S),
    T.StructField("messages", T.ArrayType(T.StructType([
        T.StructField("role", S), T.StructField("content", S), T.StructField("chartType", S),
        T.StructField("structuredData", T.ArrayType(T.MapType(S, S)))])))])

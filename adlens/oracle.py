"""The same projections and queries as SQL text for the DuckDB check.

Each query starts from the driver tables (pre-registered as views) and is
written independently of the Spark code path.
"""

from __future__ import annotations

GOOGLE_ADS = """google_ads AS (
  SELECT p_brand AS camp_name, p_type AS agroup_name, CAST(l_partkey AS VARCHAR) AS keyword_id,
         p_name AS keyword_text, l_returnflag AS device, l_linestatus AS network_type,
         REPLACE(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), '-', '') AS basic_date,
         CAST(l_shipdate AS DATE) AS report_date,
         CASE WHEN l_returnflag = 'R' AND l_quantity < 10 THEN 0 ELSE CAST(l_quantity AS BIGINT) * 100 END AS impressions,
         CAST(l_quantity AS BIGINT) AS clicks,
         l_extendedprice * 1000000 AS cost_micros,
         CAST(l_linenumber AS BIGINT) - 1 AS conversions,
         l_extendedprice * (1 - l_discount) AS conversions_value
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

KAKAO_FACTS = """kakao_facts AS (
  SELECT CASE WHEN o_custkey % 10 = 0 THEN 'x' || CAST(o_custkey AS VARCHAR)
              WHEN o_custkey % 10 = 1 THEN ' ' || CAST(o_custkey AS VARCHAR) || ' '
              ELSE CAST(o_custkey AS VARCHAR) END AS kwd_id, o_orderpriority AS agroup_id, o_orderstatus AS adv_id,
         REPLACE(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '') AS basic_date,
         CAST(o_orderdate AS DATE) AS report_date,
         o_orderkey % 1000 AS imp, o_orderkey % 37 AS click, o_totalprice AS spending,
         o_orderkey % 5 AS conv_purchase_1d, o_orderkey % 11 AS conv_purchase_7d
  FROM orders)"""

MASTER = """kakao_master AS (
  SELECT CAST(c_custkey AS VARCHAR) AS kwd_id, c_name AS kwd_name, c_mktsegment AS camp_name, 1 AS seq
  FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR) AS kwd_id, c_name AS kwd_name, CONCAT(c_mktsegment, '_v2') AS camp_name, 2 AS seq
  FROM customer WHERE c_custkey % 7 = 0),
latest_master AS (
  SELECT kwd_id, kwd_name, camp_name FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY kwd_id ORDER BY seq DESC) AS rn FROM kakao_master) WHERE rn = 1)"""

KAKAO_MASTER = MASTER + """,
kakao_ads AS (
  SELECT f.*, m.kwd_name, m.camp_name FROM kakao_facts f LEFT JOIN latest_master m ON TRIM(f.kwd_id) = m.kwd_id)"""

QUEUE_MESSAGES = """queue_messages AS (
  SELECT event_id, ts AS sent,
         CASE event_type WHEN 'click' THEN '{"platform": "google"}' WHEN 'view' THEN '{"platform": "kakao"}'
                         WHEN 'error' THEN 'not json' ELSE props END AS body,
         CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(1 + event_id % 3 AS VARCHAR) END AS receive_count,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END AS sent_ms
  FROM events)"""

CHAT_MESSAGES = """chat_messages AS (
  SELECT CONCAT(CAST(conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR)) AS message_id,
         CAST(conv_id AS VARCHAR) AS conversation_id, turn AS seq, role, text AS content
  FROM conversations)"""

WEEK = "DATE '1998-03-02' AND DATE '1998-03-08'"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


QUERIES: dict[str, str] = {}

QUERIES["google_campaign_top10"] = with_(GOOGLE_ADS) + f"""
SELECT camp_name,
       CAST(SUM(impressions) AS BIGINT) AS impressions,
       CAST(SUM(clicks) AS BIGINT) AS clicks,
       CAST((SUM(clicks) * 20000 + SUM(impressions)) // NULLIF(2 * SUM(impressions), 0) AS DOUBLE) / 100.0 AS ctr,
       CAST(ROUND(SUM(CAST(cost_micros AS DECIMAL(38,0))) / 1000000.0, 0) AS DOUBLE) AS cost,
       CAST(SUM(conversions) AS BIGINT) AS conversions,
       CAST(ROUND(SUM(CAST(conversions_value AS DECIMAL(38,6))), 0) AS DOUBLE) AS conversions_value,
       ROUND(CAST(SUM(CAST(cost_micros AS DECIMAL(38,0))) AS DOUBLE) / 1000000.0
             / NULLIF(CAST(SUM(conversions) AS DOUBLE), 0), 0) AS cost_per_conversion
FROM google_ads WHERE report_date BETWEEN {WEEK}
GROUP BY camp_name
ORDER BY conversions_value DESC NULLS LAST, camp_name ASC NULLS LAST
LIMIT 10"""

UNIFIED = """unified AS (
  SELECT 'google' AS media, report_date, camp_name AS campaign, keyword_text AS keyword,
         CAST(impressions AS BIGINT) AS impressions, CAST(clicks AS BIGINT) AS clicks,
         CAST(CAST(cost_micros AS DECIMAL(38,0)) / 1000000 AS DECIMAL(38,6)) AS cost,
         CAST(conversions AS BIGINT) AS conversions, CAST(conversions_value AS DECIMAL(38,6)) AS conv_value
  FROM google_ads
  UNION ALL
  SELECT 'kakao', report_date, NULL, NULL, CAST(imp AS BIGINT), CAST(click AS BIGINT),
         CAST(spending AS DECIMAL(38,6)), CAST(conv_purchase_7d AS BIGINT), CAST(NULL AS DECIMAL(38,6))
  FROM kakao_facts)"""


def daily_cte(lo: str, hi: str, name: str = "daily") -> str:
    return f"""{name}_raw AS (
  SELECT report_date,
         CAST(ROUND_EVEN(COALESCE(SUM(CASE WHEN media = 'google' THEN cost END), 0), 0) AS DOUBLE) AS google_cost,
         CAST(ROUND_EVEN(COALESCE(SUM(CASE WHEN media = 'kakao' THEN cost END), 0), 0) AS DOUBLE) AS kakao_cost,
         CAST(COALESCE(SUM(CASE WHEN media = 'google' THEN impressions END), 0) AS BIGINT) AS google_impressions,
         CAST(COALESCE(SUM(CASE WHEN media = 'google' THEN clicks END), 0) AS BIGINT) AS google_clicks,
         CAST(COALESCE(SUM(CASE WHEN media = 'kakao' THEN impressions END), 0) AS BIGINT) AS kakao_impressions,
         CAST(COALESCE(SUM(CASE WHEN media = 'kakao' THEN clicks END), 0) AS BIGINT) AS kakao_clicks
  FROM unified WHERE report_date BETWEEN DATE '{lo}' AND DATE '{hi}' GROUP BY report_date),
{name} AS (
  SELECT report_date, google_cost, kakao_cost, google_cost + kakao_cost AS total_cost,
         google_impressions, google_clicks, kakao_impressions, kakao_clicks,
         google_impressions + kakao_impressions AS total_impressions,
         google_clicks + kakao_clicks AS total_clicks
  FROM {name}_raw)"""


PIE = """pie AS (
  SELECT media, CAST(ROUND_EVEN(SUM(cost), 0) AS DOUBLE) AS cost
  FROM unified WHERE report_date BETWEEN DATE '1998-03-02' AND DATE '1998-03-08' GROUP BY media)"""

BASE = (GOOGLE_ADS, KAKAO_FACTS, UNIFIED)

QUERIES["kakao_campaign_top10"] = with_(KAKAO_FACTS, KAKAO_MASTER) + f"""
SELECT camp_name,
       CAST(SUM(imp) AS BIGINT) AS impressions,
       CAST(SUM(click) AS BIGINT) AS clicks,
       CAST((SUM(click) * 20000 + SUM(imp)) // NULLIF(2 * SUM(imp), 0) AS DOUBLE) / 100.0 AS ctr,
       CAST(ROUND(SUM(CAST(spending AS DECIMAL(38,6))), 0) AS DOUBLE) AS cost,
       CAST(SUM(conv_purchase_1d) AS BIGINT) AS conversions_1d,
       CAST(SUM(conv_purchase_7d) AS BIGINT) AS conversions_7d
FROM kakao_ads WHERE report_date BETWEEN {WEEK}
GROUP BY camp_name
ORDER BY cost DESC NULLS LAST, camp_name ASC NULLS LAST
LIMIT 10"""

QUERIES["overall_by_media"] = with_(GOOGLE_ADS, KAKAO_FACTS) + f"""
SELECT 'google' AS media, CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
       CAST(ROUND(SUM(CAST(cost_micros AS DECIMAL(38,0))) / 1000000.0, 0) AS DOUBLE) AS cost,
       CAST(SUM(conversions) AS BIGINT) AS conversions,
       CAST(ROUND(SUM(CAST(conversions_value AS DECIMAL(38,6))), 0) AS DOUBLE) AS conversions_value
FROM google_ads WHERE report_date BETWEEN {WEEK}
UNION ALL
SELECT 'kakao', CAST(SUM(imp) AS BIGINT), CAST(SUM(click) AS BIGINT),
       CAST(ROUND(SUM(CAST(spending AS DECIMAL(38,6))), 0) AS DOUBLE),
       CAST(SUM(conv_purchase_7d) AS BIGINT), CAST(NULL AS DOUBLE)
FROM kakao_facts WHERE report_date BETWEEN {WEEK}"""

QUERIES["unified_daily"] = with_(*BASE, daily_cte("1998-03-02", "1998-03-08")) + "SELECT * FROM daily"

QUERIES["daily_with_totals"] = with_(*BASE, daily_cte("1998-03-02", "1998-03-08")) + """
SELECT report_date, SUM(google_cost) AS google_cost, SUM(kakao_cost) AS kakao_cost, SUM(total_cost) AS total_cost,
       CAST(SUM(google_impressions) AS BIGINT) AS google_impressions, CAST(SUM(google_clicks) AS BIGINT) AS google_clicks,
       CAST(SUM(kakao_impressions) AS BIGINT) AS kakao_impressions, CAST(SUM(kakao_clicks) AS BIGINT) AS kakao_clicks,
       CAST(SUM(total_impressions) AS BIGINT) AS total_impressions, CAST(SUM(total_clicks) AS BIGINT) AS total_clicks,
       CASE WHEN GROUPING(report_date) = 1 THEN 'total' ELSE 'detail' END AS row_type
FROM daily GROUP BY GROUPING SETS ((report_date), ())"""

QUERIES["media_share"] = with_(*BASE, PIE) + """
SELECT media, cost, cost / NULLIF(SUM(cost) OVER (), 0) AS share FROM pie"""

QUERIES["kpi_totals"] = with_(*BASE, PIE, daily_cte("1998-03-02", "1998-03-08")) + """,
s AS (
  SELECT (SELECT COALESCE(SUM(CASE WHEN media = 'google' THEN cost ELSE 0 END), 0) FROM pie) AS g_pie,
         (SELECT COALESCE(SUM(CASE WHEN media = 'kakao' THEN cost ELSE 0 END), 0) FROM pie) AS k_pie,
         (SELECT COALESCE(SUM(google_cost), 0) FROM daily) AS g_tab,
         (SELECT COALESCE(SUM(kakao_cost), 0) FROM daily) AS k_tab,
         (SELECT COALESCE(SUM(total_impressions), 0) FROM daily) AS imp,
         (SELECT COALESCE(SUM(total_clicks), 0) FROM daily) AS clk),
v AS (
  SELECT CASE WHEN g_pie = 0 AND k_pie = 0 THEN g_tab ELSE g_pie END AS g,
         CASE WHEN g_pie = 0 AND k_pie = 0 THEN k_tab ELSE k_pie END AS k, imp, clk FROM s)
SELECT 'total_cost' AS metric, g + k AS value FROM v
UNION ALL SELECT 'total_impressions', CAST(imp AS DOUBLE) FROM v
UNION ALL SELECT 'total_clicks', CAST(clk AS DOUBLE) FROM v
UNION ALL SELECT 'avg_ctr', CASE WHEN imp > 0 THEN CAST((clk * 20000 + imp) // (2 * imp) AS DOUBLE) / 10000.0 ELSE 0.0 END FROM v
UNION ALL SELECT 'google_cost', g FROM v
UNION ALL SELECT 'kakao_cost', k FROM v"""

QUERIES["week_of_month"] = with_(*BASE, daily_cte("1998-03-01", "1998-03-31")) + """,
lab AS (
  SELECT CAST(month(report_date) AS VARCHAR) || '월 ' || CAST((day(report_date) - 1) // 7 + 1 AS VARCHAR) || '주차' AS week_label,
         report_date, google_cost, kakao_cost, google_clicks, kakao_clicks FROM daily),
g AS (
  SELECT week_label, SUM(google_cost) AS google_cost, SUM(kakao_cost) AS kakao_cost,
         CAST(SUM(google_clicks) AS DOUBLE) AS google_clicks, CAST(SUM(kakao_clicks) AS DOUBLE) AS kakao_clicks,
         MIN(report_date) AS first_date
  FROM lab GROUP BY week_label ORDER BY first_date LIMIT 5)
SELECT week_label, google_cost, kakao_cost, google_cost + kakao_cost AS total_cost,
       google_clicks, kakao_clicks, google_clicks + kakao_clicks AS total_clicks, first_date,
       (google_cost + kakao_cost) / NULLIF(SUM(google_cost + kakao_cost) OVER (), 0) AS share
FROM g"""

QUERIES["week_over_week"] = with_(*BASE) + """,
a AS (
  SELECT CAST(ROUND_EVEN(COALESCE(SUM(CASE WHEN report_date >= DATE '1998-03-02' AND media = 'google' THEN cost END), 0), 0) AS DOUBLE) AS tg,
         CAST(ROUND_EVEN(COALESCE(SUM(CASE WHEN report_date >= DATE '1998-03-02' AND media = 'kakao' THEN cost END), 0), 0) AS DOUBLE) AS tk,
         CAST(COALESCE(SUM(CASE WHEN report_date >= DATE '1998-03-02' THEN impressions END), 0) AS DOUBLE) AS ti,
         CAST(COALESCE(SUM(CASE WHEN report_date >= DATE '1998-03-02' THEN clicks END), 0) AS DOUBLE) AS tc,
         CAST(ROUND_EVEN(COALESCE(SUM(CASE WHEN report_date < DATE '1998-03-02' AND media = 'google' THEN cost END), 0), 0) AS DOUBLE) AS pg,
         CAST(ROUND_EVEN(COALESCE(SUM(CASE WHEN report_date < DATE '1998-03-02' AND media = 'kakao' THEN cost END), 0), 0) AS DOUBLE) AS pk,
         CAST(COALESCE(SUM(CASE WHEN report_date < DATE '1998-03-02' THEN impressions END), 0) AS DOUBLE) AS pi,
         CAST(COALESCE(SUM(CASE WHEN report_date < DATE '1998-03-02' THEN clicks END), 0) AS DOUBLE) AS pc
  FROM unified WHERE report_date BETWEEN DATE '1998-02-23' AND DATE '1998-03-08'),
m AS (
  SELECT 'total_cost' AS metric, tg + tk AS this_week, pg + pk AS prev_week FROM a
  UNION ALL SELECT 'google_cost', tg, pg FROM a
  UNION ALL SELECT 'kakao_cost', tk, pk FROM a
  UNION ALL SELECT 'total_impressions', ti, pi FROM a
  UNION ALL SELECT 'total_clicks', tc, pc FROM a)
SELECT metric, this_week, prev_week, this_week - prev_week AS change,
       (this_week - prev_week) / NULLIF(prev_week, 0) AS change_rate FROM m"""

CAMPAIGN_DETAIL = f"""cg AS (
  SELECT camp_name, CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
         CAST(ROUND_EVEN(SUM(CAST(cost_micros AS DECIMAL(38,0))) / 1000000.0, 0) AS DOUBLE) AS cost,
         CAST(SUM(conversions) AS BIGINT) AS conversions,
         CAST(ROUND_EVEN(SUM(CAST(conversions_value AS DECIMAL(38,6))), 0) AS DOUBLE) AS conv_value
  FROM google_ads WHERE report_date BETWEEN {WEEK} GROUP BY camp_name),
detail AS (
  SELECT COALESCE(camp_name, '(미분류)') AS campaign, impressions, clicks,
         CASE WHEN impressions = 0 THEN 0.0 ELSE CAST(clicks AS DOUBLE) / impressions END AS ctr,
         cost, cost / NULLIF(CAST(clicks AS DOUBLE), 0) AS cpc, conversions, conv_value,
         conv_value / NULLIF(cost, 0) AS roas
  FROM cg)"""

QUERIES["campaign_detail"] = with_(GOOGLE_ADS, CAMPAIGN_DETAIL) + "SELECT * FROM detail"

QUERIES["google_sheet"] = with_(GOOGLE_ADS, CAMPAIGN_DETAIL) + """
SELECT campaign, CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
       SUM(cost) AS cost, CAST(SUM(conversions) AS BIGINT) AS conversions, SUM(conv_value) AS conv_value,
       CASE WHEN GROUPING(campaign) = 1 THEN NULL ELSE MAX(ctr) END AS ctr,
       CASE WHEN GROUPING(campaign) = 1 THEN NULL ELSE MAX(cpc) END AS cpc,
       CASE WHEN GROUPING(campaign) = 1 THEN NULL ELSE MAX(roas) END AS roas,
       CASE WHEN GROUPING(campaign) = 1 THEN 'total' ELSE 'detail' END AS row_type
FROM detail GROUP BY GROUPING SETS ((campaign), ())"""

QUERIES["kakao_sheet"] = with_(KAKAO_FACTS, KAKAO_MASTER) + f""",
kw AS (
  SELECT kwd_id, SUM(imp) AS imp, SUM(click) AS click, SUM(CAST(spending AS DECIMAL(38,6))) AS spending
  FROM kakao_facts WHERE report_date BETWEEN {WEEK} GROUP BY kwd_id),
c AS (
  SELECT m.camp_name, CAST(SUM(imp) AS BIGINT) AS impressions, CAST(SUM(click) AS BIGINT) AS clicks,
         CAST(ROUND_EVEN(SUM(spending), 0) AS DOUBLE) AS cost
  FROM kw LEFT JOIN latest_master m ON TRIM(kw.kwd_id) = m.kwd_id GROUP BY m.camp_name),
d AS (
  SELECT COALESCE(camp_name, '(미분류)') AS campaign, impressions, clicks,
         CASE WHEN impressions = 0 THEN 0.0 ELSE CAST(clicks AS DOUBLE) / impressions END AS ctr,
         cost, cost / NULLIF(CAST(clicks AS DOUBLE), 0) AS cpc,
         cost * 1000 / NULLIF(CAST(impressions AS DOUBLE), 0) AS cpm
  FROM c)
SELECT campaign, CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
       SUM(cost) AS cost,
       CASE WHEN GROUPING(campaign) = 1 THEN NULL ELSE MAX(ctr) END AS ctr,
       CASE WHEN GROUPING(campaign) = 1 THEN NULL ELSE MAX(cpc) END AS cpc,
       CASE WHEN GROUPING(campaign) = 1 THEN NULL ELSE MAX(cpm) END AS cpm,
       CASE WHEN GROUPING(campaign) = 1 THEN 'total' ELSE 'detail' END AS row_type
FROM d GROUP BY GROUPING SETS ((campaign), ())"""

QUERIES["dashboard"] = with_(*BASE) + """,
a AS (
  SELECT media,
         CAST(ROUND_EVEN(SUM(CASE WHEN report_date = DATE '1998-03-10' THEN cost ELSE 0 END), 0) AS DOUBLE) AS today_cost,
         CAST(ROUND_EVEN(SUM(cost), 0) AS DOUBLE) AS week_cost,
         CAST(ROUND_EVEN(SUM(conv_value), 0) AS DOUBLE) AS week_conv_value,
         SUM(impressions) AS impressions, SUM(clicks) AS clicks
  FROM unified WHERE report_date BETWEEN DATE '1998-03-09' AND DATE '1998-03-10' GROUP BY media)
SELECT media, today_cost, week_cost, week_conv_value / NULLIF(week_cost, 0) AS roas,
       week_cost / NULLIF(CAST(clicks AS DOUBLE), 0) AS cpc,
       CAST((clicks * 20000 + impressions) // NULLIF(2 * impressions, 0) AS DOUBLE) / 100.0 AS ctr,
       week_cost / NULLIF(SUM(week_cost) OVER (), 0) AS share
FROM a"""

QUERIES["dashboard_trend"] = with_(*BASE) + """,
spine AS (SELECT CAST(d AS DATE) AS report_date
          FROM generate_series(DATE '1998-03-04', DATE '1998-03-10', INTERVAL 1 DAY) t(d)),
pd AS (
  SELECT report_date, SUM(conversions) AS conversions, CAST(ROUND_EVEN(SUM(cost), 0) AS DOUBLE) AS cost
  FROM unified WHERE report_date BETWEEN DATE '1998-03-04' AND DATE '1998-03-10' GROUP BY report_date)
SELECT s.report_date, CAST(COALESCE(pd.conversions, 0) AS BIGINT) AS conversions, COALESCE(pd.cost, 0.0) AS cost
FROM spine s LEFT JOIN pd ON s.report_date = pd.report_date"""

QUERIES["report_filter"] = with_(*BASE) + f"""
SELECT media, report_date, campaign, keyword, impressions, clicks, CAST(cost AS DOUBLE) AS cost, conversions
FROM unified WHERE media IN ('google') AND report_date BETWEEN {WEEK}"""

QUERIES["detail_search"] = with_(GOOGLE_ADS) + f"""
SELECT keyword_text AS keyword, CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
       CAST(ROUND(SUM(CAST(cost_micros AS DECIMAL(38,0))) / 1000000.0, 0) AS DOUBLE) AS cost
FROM google_ads
WHERE report_date BETWEEN {WEEK} AND contains(lower(keyword_text), lower('Red'))
GROUP BY keyword_text"""

RAW = """raw AS (
  SELECT CAST(event_id AS VARCHAR) AS kwd_id,
         CAST(user_id AS VARCHAR) || '-' || CAST(event_id % 1000 AS VARCHAR) AS adv_id,
         CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN '' WHEN event_id % 7 = 2 THEN 'x'
              WHEN event_id % 7 = 3 THEN ' ' || CAST(user_id AS VARCHAR) || ' ' WHEN event_id % 7 = 4 THEN 'NaN'
              ELSE CAST(user_id AS VARCHAR) || '.5' END AS imp,
         CAST(event_id % 13 AS VARCHAR) || '.' || CAST(event_id % 10 AS VARCHAR) AS click,
         CASE WHEN event_id % 11 = 0 THEN '-' ELSE CAST(user_id * 1000 + event_id % 100 AS VARCHAR) || '.25' END AS spending,
         CASE WHEN event_id % 5 = 0 THEN REPLACE(CAST(CAST(ts AS DATE) AS VARCHAR), '-', '')
              WHEN event_id % 5 = 1 THEN CAST(CAST(ts AS DATE) AS VARCHAR)
              WHEN event_id % 5 = 2 THEN CAST(year(ts) AS VARCHAR) || '-' || CAST(month(ts) AS VARCHAR) || '-' || CAST(day(ts) AS VARCHAR)
              WHEN event_id % 5 = 3 THEN '2024-13-' || CAST(day(ts) AS VARCHAR)
              ELSE '' END AS basic_date
  FROM events),
rawd AS (
  SELECT *, CAST(COALESCE(TRY_STRPTIME(TRIM(basic_date), '%Y%m%d'), TRY_STRPTIME(TRIM(basic_date), '%Y-%m-%d')) AS DATE) AS rd
  FROM raw),
bulk AS (
  SELECT kwd_id, adv_id,
         TRY_CAST(ROUND_EVEN(TRY_CAST(imp AS DOUBLE), 0) AS BIGINT) AS imp,
         TRY_CAST(ROUND_EVEN(TRY_CAST(click AS DOUBLE), 0) AS BIGINT) AS click,
         CASE WHEN isnan(TRY_CAST(spending AS DOUBLE)) THEN NULL ELSE TRY_CAST(spending AS DOUBLE) END AS spending,
         strftime(rd, '%Y-%m-%d') AS basic_date, rd AS report_date,
         strftime(rd, '%Y') AS year, strftime(rd, '%m') AS month_p, strftime(rd, '%d') AS day
  FROM rawd)"""

QUERIES["typed_bulk"] = with_(RAW) + "SELECT * FROM bulk"

QUERIES["typed_batch"] = with_(RAW) + """
SELECT COALESCE(kwd_id, '') AS kwd_id, REPLACE(COALESCE(adv_id, ''), '-', '') AS adv_id,
       COALESCE(TRY_CAST(TRUNC(TRY_CAST(imp AS DOUBLE)) AS BIGINT), 0) AS imp,
       COALESCE(TRY_CAST(TRUNC(TRY_CAST(click AS DOUBLE)) AS BIGINT), 0) AS click,
       COALESCE(TRY_CAST(spending AS DOUBLE), 0.0) AS spending,
       COALESCE(strftime(rd, '%Y%m%d'), COALESCE(basic_date, '')) AS basic_date, rd AS report_date,
       strftime(rd, '%Y') AS year, strftime(rd, '%m') AS month_p, strftime(rd, '%d') AS day
FROM rawd"""

QUERIES["valid_rows"] = with_(RAW) + """
SELECT kwd_id, report_date, year, month_p, day FROM bulk WHERE report_date IS NOT NULL"""

QUERIES["quarantine_rows"] = with_(RAW) + """
SELECT kwd_id, imp, click, spending FROM bulk WHERE report_date IS NULL"""

ROUTED = """routed AS (
  SELECT *, CASE WHEN json_valid(body) AND json_extract_string(body, '$.platform') IN ('google', 'kakao')
                 THEN json_extract_string(body, '$.platform') ELSE 'unknown' END AS platform
  FROM queue_messages)"""

QUERIES["routed"] = with_(QUEUE_MESSAGES, ROUTED) + "SELECT event_id, platform FROM routed"

DEAD = """dead AS (
  SELECT *, CASE WHEN json_valid(body) AND json_type(body) = 'OBJECT'
                 THEN COALESCE(json_extract_string(body, '$.platform'), 'unknown') ELSE 'unknown' END AS platform
  FROM queue_messages)"""

QUERIES["failed_counts"] = with_(QUEUE_MESSAGES, DEAD) + """
SELECT platform, COUNT(*) AS n FROM dead GROUP BY platform"""

QUERIES["dead_letters"] = with_(QUEUE_MESSAGES, DEAD) + """
SELECT event_id, platform,
       COALESCE(strftime(make_timestamp(TRY_CAST(sent_ms AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S'), 'unknown') AS sent_time,
       COALESCE(receive_count, 'unknown') AS receive_count
FROM dead"""

ITEMS = """items AS (
  SELECT conversation_id,
         arg_min(content, seq) FILTER (WHERE role = 'user') AS title,
         COUNT(*) AS n_messages, MAX(seq) AS last_seq,
         'u' || CAST(CAST(conversation_id AS BIGINT) % 23 AS VARCHAR) AS user_id
  FROM chat_messages GROUP BY conversation_id)"""

REPORTS = """reports AS (
  SELECT 'r' || CAST(o_orderkey AS VARCHAR) AS report_id,
         'u' || CAST(o_custkey % 23 AS VARCHAR) AS user_id,
         'weekly' AS type,
         CAST(o_orderdate AS DATE) - (CAST(isodow(o_orderdate) AS INTEGER) - 1 + 7) AS period_start,
         CAST(o_orderdate AS DATE) - (CAST(isodow(o_orderdate) AS INTEGER) - 1 + 7) + 6 AS period_end,
         o_orderdate AS created_at,
         o_orderdate + INTERVAL 90 DAY AS expires_at
  FROM orders)"""

QUERIES["messages_in_order"] = with_(CHAT_MESSAGES) + """
SELECT message_id, conversation_id, seq, role,
       ROW_NUMBER() OVER (PARTITION BY conversation_id ORDER BY seq, message_id) AS position
FROM chat_messages"""

QUERIES["latest_message"] = with_(CHAT_MESSAGES) + """
SELECT conversation_id, seq, message_id, role, content FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY conversation_id ORDER BY seq DESC) AS rn FROM chat_messages)
WHERE rn = 1"""

QUERIES["conversations_by_user"] = with_(CHAT_MESSAGES, ITEMS) + """
SELECT conversation_id, user_id, n_messages, last_seq,
       ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY last_seq DESC, conversation_id ASC) AS position
FROM items"""

QUERIES["title_search"] = with_(CHAT_MESSAGES, ITEMS) + """
SELECT conversation_id, title FROM items WHERE contains(lower(title), lower('Pour'))"""

QUERIES["conversations_with_report"] = with_(CHAT_MESSAGES, ITEMS, REPORTS) + """
SELECT i.conversation_id, i.report_key, r.period_start, r.period_end, r.created_at
FROM (SELECT *, CASE WHEN CAST(conversation_id AS BIGINT) % 3 = 0 THEN 'r' || conversation_id END AS report_key
      FROM items) i
LEFT JOIN reports r ON i.report_key = r.report_id"""

QUERIES["reports_by_month"] = with_(REPORTS) + """
SELECT year(created_at) AS year, month(created_at) AS month, COUNT(*) AS n_reports,
       MIN(created_at) AS first_created, MAX(created_at) AS last_created
FROM reports GROUP BY 1, 2"""

QUERIES["active_reports"] = with_(REPORTS) + """
SELECT user_id, report_id, expires_at,
       ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY expires_at, report_id) AS position
FROM reports WHERE expires_at > TIMESTAMP '1999-06-01 00:00:00'"""

KAKAO_ROWS = """krows AS (
  SELECT kwd_id, agroup_id, adv_id, basic_date, imp, click, spending, conv_purchase_1d, conv_purchase_7d,
         report_date, strftime(report_date, '%Y') AS year, strftime(report_date, '%m') AS month_p,
         strftime(report_date, '%d') AS day
  FROM kakao_facts)"""

QUERIES["parquet_roundtrip"] = with_(KAKAO_FACTS, KAKAO_ROWS) + "SELECT * FROM krows"

QUERIES["rewrite_day"] = with_(KAKAO_FACTS, KAKAO_ROWS) + """
SELECT kwd_id, agroup_id, adv_id, basic_date,
       CASE WHEN report_date = DATE '1998-03-05' THEN imp * 2 ELSE imp END AS imp,
       click, spending, conv_purchase_1d, conv_purchase_7d, report_date, year, month_p, day
FROM krows"""

QUERIES["catalog_scan"] = with_(KAKAO_FACTS, KAKAO_ROWS) + """
SELECT year, month_p, COUNT(*) AS n, CAST(SUM(imp) AS BIGINT) AS imp,
       CAST(ROUND(SUM(CAST(spending AS DECIMAL(38,6))), 0) AS DOUBLE) AS spending
FROM krows GROUP BY year, month_p"""

QUERIES["csv_roundtrip"] = with_(MASTER) + """
SELECT kwd_id, kwd_name, camp_name, '캠페인 ' || camp_name AS label FROM latest_master"""

QUERIES["json_flatten"] = """
SELECT p_brand AS camp_name, CAST(l_partkey AS VARCHAR) AS keyword_id, p_name AS keyword_text,
       l_returnflag AS device, l_linestatus AS network_type, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date,
       REPLACE(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), '-', '') AS basic_date, '1234567890' AS adv_id,
       CAST(TRUNC(l_quantity * 100) AS BIGINT) AS impressions, CAST(TRUNC(l_quantity) AS BIGINT) AS clicks,
       l_extendedprice * 1000000 AS cost_micros, CAST(l_linenumber - 1 AS BIGINT) AS conversions,
       l_extendedprice * (1 - l_discount) AS conversions_value, 0.0 AS ctr, CAST(0 AS BIGINT) AS video_views
FROM lineitem JOIN part ON l_partkey = p_partkey"""

QUERIES["accounts"] = """
SELECT CAST(o_custkey AS VARCHAR) AS kwd_id, o_orderpriority AS agroup_id, o_orderstatus AS adv_id,
       REPLACE(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '') AS basic_date,
       o_orderkey % 1000 AS imp, o_orderkey % 37 AS click, o_totalprice AS spending,
       o_orderkey % 5 AS conv_purchase_1d, o_orderkey % 11 AS conv_purchase_7d,
       CAST(0 AS BIGINT) AS rank, 0.0 AS ctr
FROM orders WHERE o_orderstatus <> 'P'"""

QUERIES["stream_failed_counts"] = with_(QUEUE_MESSAGES, DEAD) + """
SELECT (TRY_CAST(sent_ms AS BIGINT) // 300000) * 300000 AS window_start_ms,
       (TRY_CAST(sent_ms AS BIGINT) // 300000) * 300000 + 300000 AS window_end_ms,
       platform, COUNT(*) AS n
FROM dead WHERE sent_ms IS NOT NULL GROUP BY 1, 2, 3"""

QUERIES["stream_routes"] = with_(QUEUE_MESSAGES, ROUTED, DEAD) + """
SELECT CAST(d.event_id AS VARCHAR) AS message_id, d.platform AS platform,
       COALESCE(d.receive_count, 'unknown') AS receive_count,
       CASE WHEN r.platform = 'unknown' THEN 'quarantine' ELSE 'good' END AS route
FROM dead d JOIN routed r ON d.event_id = r.event_id"""

QUERIES["stream_ingest"] = """
SELECT p_brand AS camp_name, CAST(l_partkey AS VARCHAR) AS keyword_id, p_name AS keyword_text,
       REPLACE(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), '-', '') AS basic_date,
       CAST(l_shipdate AS DATE) AS report_date, '1234567890' AS adv_id,
       CAST(TRUNC(l_quantity * 100 * CASE WHEN CAST(l_shipdate AS DATE) = DATE '1998-03-05' THEN 2 ELSE 1 END) AS BIGINT) AS impressions,
       CAST(TRUNC(l_quantity) AS BIGINT) AS clicks,
       l_extendedprice * 1000000 AS cost_micros, l_extendedprice * (1 - l_discount) AS conversions_value,
       strftime(l_shipdate, '%Y') AS year, strftime(l_shipdate, '%m') AS month_p, strftime(l_shipdate, '%d') AS day
FROM lineitem JOIN part ON l_partkey = p_partkey"""

WEEKS = """wk AS (
  SELECT *, report_date - CAST(isodow(report_date) - 1 AS INTEGER) AS week FROM unified)"""

QUERIES["report_datasets"] = with_(*BASE, WEEKS) + """
SELECT 'w' || strftime(week, '%Y%m%d') AS report_id, 'pie' AS chart_type,
       CAST(COUNT(DISTINCT media) + 1 AS BIGINT) AS n_rows, CAST(6 AS BIGINT) AS message_pos FROM wk GROUP BY week
UNION ALL
SELECT 'w' || strftime(week, '%Y%m%d'), 'line', CAST(COUNT(DISTINCT report_date) AS BIGINT), 3 FROM wk GROUP BY week
UNION ALL
SELECT 'w' || strftime(week, '%Y%m%d'), 'table', CAST(COUNT(DISTINCT report_date) + 1 AS BIGINT), 5 FROM wk GROUP BY week
UNION ALL
SELECT 'w' || strftime(week, '%Y%m%d'), 'bar',
       CAST(COUNT(DISTINCT CASE WHEN media = 'google' THEN campaign END) + 2 AS BIGINT), 4
FROM wk GROUP BY week"""

QUERIES["report_texts"] = with_(*BASE, WEEKS) + """
SELECT 'w' || strftime(week, '%Y%m%d') AS report_id, CAST(2 AS BIGINT) AS n_texts,
       'week of ' || strftime(week, '%Y-%m-%d') || ' | google clicks ' ||
       CAST(COALESCE(SUM(CASE WHEN media = 'google' THEN clicks END), 0) AS VARCHAR) AS texts
FROM wk GROUP BY week
UNION ALL SELECT 'empty', 1, 'no data in regions ' || CAST(COUNT(*) AS VARCHAR) FROM region"""

QUERIES["report_pie"] = with_(*BASE, WEEKS) + """
SELECT 'w' || strftime(week, '%Y%m%d') AS report_id,
       CAST(ROW_NUMBER() OVER (PARTITION BY week ORDER BY media) - 1 AS BIGINT) AS pos,
       media, CAST(ROUND_EVEN(SUM(cost), 0) AS DOUBLE) AS cost
FROM wk GROUP BY week, media
UNION ALL
SELECT 'w' || strftime(week, '%Y%m%d'), COUNT(DISTINCT media), 'google', 7.0 FROM wk GROUP BY week"""

QUERIES["report_titles"] = with_(*BASE, WEEKS) + """
SELECT DISTINCT 'w' || strftime(week, '%Y%m%d') AS report_id, '주간 리포트 ' || strftime(week, '%Y-%m-%d') AS title,
       strftime(week + 7, '%Y년 %m월 %d일') AS created
FROM wk
UNION ALL SELECT 'empty', '주간 리포트 empty', '1998년 12월 31일'"""

QUERIES["sheets_roundtrip"] = f"""
SELECT 'daily' AS sheet, CAST(report_date AS VARCHAR) AS label, total_cost AS cost, row_type
FROM ({QUERIES["daily_with_totals"]})
UNION ALL SELECT 'google', campaign, cost, row_type FROM ({QUERIES["google_sheet"]})
UNION ALL SELECT 'kakao', campaign, cost, row_type FROM ({QUERIES["kakao_sheet"]})"""

QUERIES["weekly_report"] = with_(GOOGLE_ADS, KAKAO_FACTS, KAKAO_MASTER) + f""",
g AS (
  SELECT camp_name, GROUPING(camp_name) AS gg,
         CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
         CAST((SUM(clicks) * 20000 + SUM(impressions)) // NULLIF(2 * SUM(impressions), 0) AS DOUBLE) / 100.0 AS ctr,
         CAST(ROUND(SUM(CAST(cost_micros AS DECIMAL(38,0))) / 1000000.0, 0) AS DOUBLE) AS cost,
         CAST(SUM(conversions) AS BIGINT) AS conversions,
         CAST(ROUND(SUM(CAST(conversions_value AS DECIMAL(38,6))), 0) AS DOUBLE) AS conversions_value,
         ROUND(CAST(SUM(CAST(cost_micros AS DECIMAL(38,0))) AS DOUBLE) / 1000000.0
               / NULLIF(CAST(SUM(conversions) AS DOUBLE), 0), 0) AS cost_per_conversion
  FROM google_ads WHERE report_date BETWEEN {WEEK} GROUP BY GROUPING SETS ((camp_name), ())),
k AS (
  SELECT camp_name, GROUPING(camp_name) AS gg,
         CAST(SUM(imp) AS BIGINT) AS impressions, CAST(SUM(click) AS BIGINT) AS clicks,
         CAST((SUM(click) * 20000 + SUM(imp)) // NULLIF(2 * SUM(imp), 0) AS DOUBLE) / 100.0 AS ctr,
         CAST(ROUND(SUM(CAST(spending AS DECIMAL(38,6))), 0) AS DOUBLE) AS cost,
         CAST(SUM(conv_purchase_1d) AS BIGINT) AS conversions_1d,
         CAST(SUM(conv_purchase_7d) AS BIGINT) AS conversions_7d
  FROM kakao_ads WHERE report_date BETWEEN {WEEK} GROUP BY GROUPING SETS ((camp_name), ())),
parts AS (
  SELECT * FROM (SELECT 'google_top' AS section, camp_name, impressions, clicks, ctr, cost, conversions,
                        conversions_value, cost_per_conversion, CAST(NULL AS BIGINT) AS conversions_1d,
                        CAST(NULL AS BIGINT) AS conversions_7d
                 FROM g WHERE gg = 0
                 ORDER BY conversions_value DESC NULLS LAST, camp_name ASC NULLS LAST LIMIT 10)
  UNION ALL
  SELECT 'google_total', camp_name, impressions, clicks, ctr, cost, conversions, conversions_value,
         cost_per_conversion, NULL, NULL FROM g WHERE gg = 1
  UNION ALL
  SELECT * FROM (SELECT 'kakao_top', camp_name, impressions, clicks, ctr, cost, conversions_7d,
                        CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), conversions_1d, conversions_7d
                 FROM k WHERE gg = 0 ORDER BY cost DESC NULLS LAST, camp_name ASC NULLS LAST LIMIT 10)
  UNION ALL
  SELECT 'kakao_total', camp_name, impressions, clicks, ctr, cost, conversions_7d, NULL, NULL,
         conversions_1d, conversions_7d FROM k WHERE gg = 1)
SELECT *, DATE '1998-03-02' AS period_start, DATE '1998-03-08' AS period_end,
       strftime(DATE '1998-03-02', '%Y년 %m월 %d일') AS period_start_text,
       strftime(DATE '1998-03-08', '%Y년 %m월 %d일') AS period_end_text
FROM parts"""

QUERIES["row_counts"] = with_(RAW, KAKAO_FACTS, KAKAO_MASTER) + """
SELECT 'read' AS stage, COUNT(*) AS rows FROM raw
UNION ALL SELECT 'valid', COUNT(*) FROM bulk WHERE report_date IS NOT NULL
UNION ALL SELECT 'quarantined', COUNT(*) FROM bulk WHERE report_date IS NULL
UNION ALL SELECT 'enriched', COUNT(*) FROM kakao_ads"""

DOC_WEEK = """dd AS (
  SELECT week, report_date,
         CAST(ROUND_EVEN(COALESCE(SUM(CASE WHEN media = 'google' THEN cost END), 0), 0) AS DOUBLE) AS gc,
         CAST(ROUND_EVEN(COALESCE(SUM(CASE WHEN media = 'kakao' THEN cost END), 0), 0) AS DOUBLE) AS kc,
         CAST(COALESCE(SUM(CASE WHEN media = 'google' THEN impressions END), 0) AS DOUBLE) AS gi,
         CAST(COALESCE(SUM(CASE WHEN media = 'google' THEN clicks END), 0) AS DOUBLE) AS gk,
         CAST(COALESCE(SUM(CASE WHEN media = 'kakao' THEN impressions END), 0) AS DOUBLE) AS ki,
         CAST(COALESCE(SUM(CASE WHEN media = 'kakao' THEN clicks END), 0) AS DOUBLE) AS kk
  FROM wk GROUP BY week, report_date),
pm AS (
  SELECT week,
         COALESCE(SUM(CASE WHEN media = 'google' THEN c END), 7) AS g_pie,
         COALESCE(SUM(CASE WHEN media = 'kakao' THEN c END), 0) AS k_pie
  FROM (SELECT week, media, CAST(ROUND_EVEN(SUM(cost), 0) AS DOUBLE) AS c FROM wk GROUP BY week, media)
  GROUP BY week)"""

QUERIES["doc_kpi"] = with_(*BASE, WEEKS, DOC_WEEK) + """,
s AS (
  SELECT pm.week, g_pie, k_pie, SUM(gc) + 5 AS g_tab, SUM(kc) AS k_tab, SUM(gi) + SUM(ki) AS imp,
         SUM(gk) + SUM(kk) + 1 AS clk
  FROM pm JOIN dd ON pm.week = dd.week GROUP BY pm.week, g_pie, k_pie
  UNION ALL SELECT NULL, 0, 0, 0, 0, 0, 0),
v AS (
  SELECT COALESCE('w' || strftime(week, '%Y%m%d'), 'empty') AS report_id,
         CASE WHEN g_pie = 0 AND k_pie = 0 THEN g_tab ELSE g_pie END AS g,
         CASE WHEN g_pie = 0 AND k_pie = 0 THEN k_tab ELSE k_pie END AS k, imp, clk FROM s)
SELECT report_id, 'total_cost' AS metric, g + k AS value FROM v
UNION ALL SELECT report_id, 'total_impressions', imp FROM v
UNION ALL SELECT report_id, 'total_clicks', clk FROM v
UNION ALL SELECT report_id, 'avg_ctr', CASE WHEN imp > 0 THEN CAST((CAST(clk AS BIGINT) * 20000 + CAST(imp AS BIGINT))
                                                   // (2 * CAST(imp AS BIGINT)) AS DOUBLE) / 10000.0 ELSE 0.0 END FROM v
UNION ALL SELECT report_id, 'google_cost', g FROM v
UNION ALL SELECT report_id, 'kakao_cost', k FROM v"""

QUERIES["doc_week_of_month"] = with_(*BASE, WEEKS, DOC_WEEK) + """,
lab AS (
  SELECT week, report_date, gc, kc, gk, kk,
         CAST(month(report_date) AS VARCHAR) || '월 ' || CAST((day(report_date) - 1) // 7 + 1 AS VARCHAR) || '주차' AS week_label
  FROM dd
  UNION ALL SELECT DISTINCT week, NULL::DATE, 5, 0, 1, 0, '합계' FROM dd),
g AS (
  SELECT week, week_label, SUM(gc) AS google_cost, SUM(kc) AS kakao_cost, SUM(gk) AS google_clicks,
         SUM(kk) AS kakao_clicks, MIN(report_date) AS first_date
  FROM lab GROUP BY week, week_label),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY week ORDER BY first_date NULLS LAST, week_label) AS rn FROM g)
SELECT 'w' || strftime(week, '%Y%m%d') AS report_id, week_label, google_cost, kakao_cost,
       google_cost + kakao_cost AS total_cost, google_clicks, kakao_clicks,
       google_clicks + kakao_clicks AS total_clicks, first_date,
       (google_cost + kakao_cost) / NULLIF(SUM(google_cost + kakao_cost) OVER (PARTITION BY week), 0) AS share
FROM r WHERE rn <= 5
UNION ALL
SELECT 'empty', 'W' || CAST(k AS VARCHAR), 0, 0, 0, 0, 0, 0, NULL, NULL FROM (SELECT unnest(range(1, 6)) AS k)"""

QUERIES["doc_daily_sheet"] = with_(*BASE, WEEKS, DOC_WEEK) + """
SELECT 'w' || strftime(week, '%Y%m%d') AS report_id,
       CASE WHEN GROUPING(report_date) = 1 THEN NULL ELSE strftime(report_date, '%Y-%m-%d') END AS date,
       SUM(gc) AS google_cost, SUM(kc) AS kakao_cost, SUM(m * gi) AS google_impressions, SUM(m * gk) AS google_clicks,
       SUM(m * ki) AS kakao_impressions, SUM(m * kk) AS kakao_clicks, SUM(gc + kc) AS total_cost,
       SUM(m * (gi + ki)) AS total_impressions, SUM(m * (gk + kk)) AS total_clicks,
       CASE WHEN GROUPING(report_date) = 1 THEN 'total' ELSE 'detail' END AS row_type
FROM (SELECT *, CASE WHEN isodow(report_date) = 1
                      AND strftime(report_date, '%Y-%m-%d') <> CAST(year(report_date) AS VARCHAR) || '-'
                          || CAST(month(report_date) AS VARCHAR) || '-' || CAST(day(report_date) AS VARCHAR)
                     THEN 0.0 ELSE 1.0 END AS m FROM dd) GROUP BY GROUPING SETS ((week, report_date), (week))"""

QUERIES["google_top10_from_table"] = QUERIES["google_campaign_top10"]

QUERIES["bulk_load_kakao"] = with_(RAW, MASTER) + """,
kw AS (
  SELECT CAST(CAST(kwd_id AS BIGINT) % 2000 AS VARCHAR) AS k2, * FROM bulk)
SELECT kw.k2 AS kwd_id, kw.adv_id, kw.imp, kw.click, kw.spending, kw.basic_date, m.kwd_name, m.camp_name,
       kw.report_date, kw.year, kw.month_p, kw.day
FROM kw LEFT JOIN latest_master m ON kw.k2 = m.kwd_id
WHERE kw.report_date IS NOT NULL"""

QUERIES["doc_google_sheet"] = with_(*BASE, WEEKS) + """,
c AS (
  SELECT week, campaign, CAST(SUM(impressions) AS DOUBLE) AS impressions, CAST(SUM(clicks) AS DOUBLE) AS clicks,
         CAST(ROUND_EVEN(SUM(cost), 0) AS DOUBLE) AS cost, CAST(SUM(conversions) AS DOUBLE) AS conversions,
         CAST(ROUND_EVEN(SUM(conv_value), 0) AS DOUBLE) AS conv_value
  FROM wk WHERE media = 'google' GROUP BY week, campaign
  UNION ALL SELECT DISTINCT week, NULL, 10, 2, 3, 1, 4 FROM wk
  UNION ALL SELECT DISTINCT week, '(미분류)', 10, 2, 3, 1, 4 FROM wk),
d AS (
  SELECT 'w' || strftime(week, '%Y%m%d') AS report_id,
         ROW_NUMBER() OVER (PARTITION BY week ORDER BY campaign IS NULL OR campaign = '(미분류)', campaign IS NOT NULL,
                            campaign) - 1 AS pos,
         COALESCE(campaign, '(미분류)') AS campaign, impressions, clicks, cost, conversions, conv_value,
         CASE WHEN impressions = 0 THEN 0.0 ELSE clicks / impressions END AS ctr,
         cost / NULLIF(clicks, 0) AS cpc, conv_value / NULLIF(cost, 0) AS roas
  FROM c)
SELECT report_id, CAST(pos AS BIGINT) AS pos,
       SUM(impressions) AS impressions, SUM(clicks) AS clicks, SUM(cost) AS cost,
       SUM(conversions) AS conversions, SUM(conv_value) AS conv_value,
       CASE WHEN GROUPING(pos) = 1 THEN NULL ELSE MAX(campaign) END AS campaign,
       CASE WHEN GROUPING(pos) = 1 THEN NULL ELSE MAX(ctr) END AS ctr,
       CASE WHEN GROUPING(pos) = 1 THEN NULL ELSE MAX(cpc) END AS cpc,
       CASE WHEN GROUPING(pos) = 1 THEN NULL ELSE MAX(roas) END AS roas,
       CASE WHEN GROUPING(pos) = 1 THEN 'total' ELSE 'detail' END AS row_type
FROM d GROUP BY GROUPING SETS ((report_id, pos), (report_id))"""

QUERIES["doc_kakao_sheet"] = with_(*BASE, WEEKS) + """,
p AS (
  SELECT week, media, CAST(ROUND_EVEN(SUM(cost), 0) AS DOUBLE) AS cost,
         ROW_NUMBER() OVER (PARTITION BY week ORDER BY media) - 1 AS pos
  FROM wk GROUP BY week, media)
SELECT 'w' || strftime(week, '%Y%m%d') AS report_id, 'kakao_total' AS row_type, '카카오' AS media_name,
       COALESCE(MAX(CASE WHEN media = 'kakao' THEN cost END), 0.0) AS cost, CAST(NULL AS BIGINT) AS pos
FROM p GROUP BY week
UNION ALL
SELECT 'w' || strftime(week, '%Y%m%d'), 'media', CASE media WHEN 'google' THEN '구글' ELSE '카카오' END,
       cost, CAST(pos AS BIGINT)
FROM p
UNION ALL SELECT 'w' || strftime(week, '%Y%m%d'), 'media', '구글', 7.0, COUNT(*) FROM p GROUP BY week
UNION ALL SELECT 'empty', 'kakao_total', '카카오', 0.0, NULL"""

QUERIES["doc_media_share"] = with_(*BASE, WEEKS, DOC_WEEK) + """,
s AS (
  SELECT pm.week, g_pie, k_pie, SUM(gc) + 5 AS g_tab, SUM(kc) AS k_tab
  FROM pm JOIN dd ON pm.week = dd.week GROUP BY pm.week, g_pie, k_pie
  UNION ALL SELECT NULL, 0, 0, 0, 0),
v AS (
  SELECT COALESCE('w' || strftime(week, '%Y%m%d'), 'empty') AS report_id,
         CASE WHEN g_pie = 0 AND k_pie = 0 THEN g_tab ELSE g_pie END AS g,
         CASE WHEN g_pie = 0 AND k_pie = 0 THEN k_tab ELSE k_pie END AS k FROM s),
m AS (
  SELECT report_id, 'google' AS media, CAST(ROUND_EVEN(g, 0) AS DOUBLE) AS cost FROM v
  UNION ALL SELECT report_id, 'kakao', CAST(ROUND_EVEN(k, 0) AS DOUBLE) FROM v)
SELECT report_id, media, cost, cost / NULLIF(SUM(cost) OVER (PARTITION BY report_id), 0) AS share FROM m"""

QUERIES["stream_untimed_counts"] = with_(QUEUE_MESSAGES, DEAD) + """
SELECT platform, COUNT(*) AS n FROM dead WHERE sent_ms IS NULL GROUP BY platform"""

QUERIES["dashboard_cached"] = QUERIES["dashboard"]

# ---- loads, tables and small operators registered in the second round

QUERIES["kakao_top10_from_table"] = QUERIES["kakao_campaign_top10"]

_KAKAO_STORED = """
SELECT TRIM(kwd_id) AS kwd_id, adv_id, basic_date, imp, click, spending, camp_name, report_date,
       strftime(report_date, '%Y') AS year, strftime(report_date, '%m') AS month_p, strftime(report_date, '%d') AS day
FROM kakao_ads"""

QUERIES["batch_load_kakao"] = with_(KAKAO_FACTS, KAKAO_MASTER) + _KAKAO_STORED + " WHERE adv_id <> 'P'"

QUERIES["batch_load_google"] = """
SELECT p_brand AS camp_name, CAST(l_partkey AS VARCHAR) AS keyword_id, '1234567890' AS adv_id,
       REPLACE(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), '-', '') AS basic_date, CAST(l_shipdate AS DATE) AS report_date,
       CAST(TRUNC(l_quantity * 100) AS BIGINT) AS impressions, CAST(TRUNC(l_quantity) AS BIGINT) AS clicks
FROM lineitem JOIN part ON l_partkey = p_partkey"""

QUERIES["bulk_load_google"] = with_(GOOGLE_ADS) + f"""
SELECT camp_name, keyword_id, basic_date, report_date, strftime(report_date + 7, '%Y-%m-%d') AS date,
       impressions, clicks, cost_micros, strftime(report_date, '%Y') AS year,
       strftime(report_date, '%m') AS month_p, strftime(report_date, '%d') AS day
FROM google_ads WHERE report_date BETWEEN {WEEK}"""

QUERIES["bulk_load_kakao_file_order"] = QUERIES["bulk_load_kakao"]

QUERIES["day_rows"] = with_(GOOGLE_ADS) + """
SELECT camp_name, COUNT(*) AS n, CAST(SUM(clicks) AS BIGINT) AS clicks
FROM google_ads WHERE report_date = DATE '1998-03-05' GROUP BY camp_name"""

QUERIES["detail_by_date"] = with_(*BASE, daily_cte("1998-03-01", "1998-03-31")) + """
SELECT report_date, google_cost, kakao_cost FROM daily"""

QUERIES["detail_sorted"] = with_(GOOGLE_ADS, CAMPAIGN_DETAIL) + "SELECT campaign, clicks, cost FROM detail"

QUERIES["found_dates"] = with_(RAW) + """
SELECT kwd_id, CASE WHEN regexp_matches(basic_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN basic_date
                    ELSE basic_date END AS found
FROM raw"""

QUERIES["media_totals_named"] = with_(*BASE, WEEKS) + """,
p AS (
  SELECT week, media, CAST(ROUND_EVEN(SUM(cost), 0) AS DOUBLE) AS cost,
         ROW_NUMBER() OVER (PARTITION BY week ORDER BY media) - 1 AS pos FROM wk GROUP BY week, media
  UNION ALL SELECT week, 'google', 7.0, COUNT(DISTINCT media) FROM wk GROUP BY week)
SELECT CASE WHEN media = 'google' THEN '매체' || CAST(pos + 1 AS VARCHAR) ELSE media END AS media,
       SUM(cost) AS cost, CAST(MIN(pos) AS BIGINT) AS pos
FROM p GROUP BY 1"""

QUERIES["result_texts"] = with_(RAW) + """
SELECT COALESCE(kwd_id, '') AS kwd_id, COALESCE(CAST(imp AS VARCHAR), '') AS imp,
       COALESCE(CAST(click AS VARCHAR), '') AS click, COALESCE(CAST(report_date AS VARCHAR), '') AS report_date
FROM bulk"""

QUERIES["stream_redelivered_counts"] = QUERIES["stream_failed_counts"]

_TIMED = """, timed AS (
  SELECT event_id, platform, TRY_CAST(sent_ms AS BIGINT) AS ms, (event_id % 30) > 18 AND sent_ms IS NOT NULL AS late FROM dead)"""

QUERIES["stream_all_counts"] = with_(QUEUE_MESSAGES, DEAD) + _TIMED + """
SELECT (ms // 300000) * 300000 AS window_start_ms, (ms // 300000) * 300000 + 300000 AS window_end_ms, platform, COUNT(*) AS n
FROM timed WHERE NOT late GROUP BY 1, 2, 3"""

QUERIES["stream_late_messages"] = with_(QUEUE_MESSAGES, DEAD) + _TIMED + """
SELECT CAST(event_id AS VARCHAR) AS message_id, platform, ms AS sent_ms, ms + (event_id % 30) * 86400000 AS received_ms
FROM timed WHERE late"""

QUERIES["stream_outcomes"] = with_(QUEUE_MESSAGES, DEAD) + """
SELECT CAST(event_id AS VARCHAR) AS message_id, platform,
       CASE WHEN event_id % 5 < 3 THEN 'good' ELSE 'dead-letter' END AS route, LEAST(event_id % 5 + 1, 3) AS receives
FROM dead"""

QUERIES["csv_dialects"] = with_(RAW) + """
SELECT CAST(CAST(kwd_id AS BIGINT) % 2000 AS VARCHAR) AS kwd_id, adv_id, 'g1' AS agroup_id, NULLIF(imp, '') AS imp, click,
       spending, NULLIF(basic_date, '') AS basic_date
FROM raw"""

QUERIES["csv_line_breaks"] = with_(CHAT_MESSAGES) + """
SELECT message_id, role, content || chr(10) || '"' || role || '"' || chr(10) || chr(10) || ', ; end' AS content
FROM chat_messages"""

QUERIES["weekly_report_from_partials"] = QUERIES["weekly_report"]
QUERIES["overall_from_partials"] = QUERIES["overall_by_media"]
QUERIES["dashboard_from_partials"] = QUERIES["dashboard"]
QUERIES["trend_from_partials"] = QUERIES["dashboard_trend"]
QUERIES["daily_from_partials"] = QUERIES["daily_with_totals"]
QUERIES["week_over_week_from_partials"] = QUERIES["week_over_week"]
QUERIES["bound_sql"] = with_(GOOGLE_ADS) + f"""
SELECT camp_name, CAST(SUM(clicks) AS BIGINT) AS clicks FROM google_ads
WHERE report_date BETWEEN {WEEK} GROUP BY camp_name"""

QUERIES["stored_conversations"] = f"SELECT * FROM ({QUERIES['conversations_by_user']}) WHERE user_id = 'u5'"
QUERIES["stored_messages"] = f"SELECT * FROM ({QUERIES['messages_in_order']}) WHERE conversation_id = '7'"
QUERIES["stored_reports"] = f"SELECT * FROM ({QUERIES['active_reports']}) WHERE user_id = 'u5'"
QUERIES["dashboard_from_table"] = QUERIES["dashboard"]

QUERIES["title_search_stored"] = QUERIES["title_search"]
QUERIES["detail_search_stored"] = QUERIES["detail_search"]

QUERIES["stream_ingest_counts"] = """
WITH n AS (SELECT COUNT(*) AS every, COUNT(*) FILTER (CAST(l_shipdate AS DATE) = DATE '1998-03-05') AS one
           FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT CAST(9 AS BIGINT) AS run, every AS read, every - one AS written, one AS superseded, CAST(0 AS BIGINT) AS quarantined FROM n
UNION ALL SELECT 10, one, one, 0, 0 FROM n"""

QUERIES["bulk_load_counts"] = with_(RAW) + """
SELECT 'read' AS stage, COUNT(*) AS rows FROM raw
UNION ALL SELECT 'enriched', COUNT(*) FROM raw
UNION ALL SELECT 'written', COUNT(*) FROM bulk WHERE report_date IS NOT NULL
UNION ALL SELECT 'quarantined', COUNT(*) FROM bulk WHERE report_date IS NULL"""

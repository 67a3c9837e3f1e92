"""Landed documents built from the driver tables, for round trips through
the readers: google responses from lineitem x part, kakao per-account
responses and the account list from orders, the keyword master as CSV.

Rows are packed into documents of bounded size (a document holds the rows
of at most 100 order keys, or of one day of 10,000), so no document grows with a hot key or day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import labels as L
from ..session import FREEING, isolated
from .fixtures import kakao_master, table

# Text of our own fixture documents (not reference values).
MASTER_LABEL_PREFIX = "캠페인 "
REPORT_TITLE_PREFIX = "주간 리포트 "
SUM_LABEL = "합계"

FAILED_ACCOUNT = "P"          # the account whose response failed
CUSTOMER_ID = "123-456-7890"  # landed google customer id (dashes removed on ingest)


#: Landed documents are text that says the same names in every row; they are written compressed.
LANDED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _packed(rows: DataFrame, result, *keys) -> DataFrame:
    """Documents of ``rows`` by ``keys``: the plain values are moved and gathered, and ``result`` makes a row of them
    inside its document, so names and fixed texts are not shuffled. Rows are moved before they are gathered: few of a
    document meet in a task before."""
    values = F.struct(*[F.col(c) for c in rows.columns])
    gathered = rows.repartition(*keys).groupBy(*keys).agg(F.collect_list(values).alias("rows"))
    return gathered.withColumn("results", F.transform("rows", result))


def google_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    pa = table(spark, sf_dir, "part")
    j = li.join(pa, li.l_partkey == pa.p_partkey).select(
        "l_orderkey", "p_size", "p_brand", "p_type", "l_partkey", "p_name", "l_returnflag", "l_linestatus",
        F.col("l_shipdate").cast("date").alias("day"), "l_quantity", "l_linenumber", "l_extendedprice", "l_discount")

    def result(r):
        s = lambda c: r[c].cast("string")
        return F.struct(
            F.struct(s("p_size").alias("id"), r["p_brand"].alias("name"),
                     F.lit("SEARCH").alias("advertisingChannelType"), F.lit("ENABLED").alias("status")).alias("campaign"),
            F.struct(r["p_type"].alias("id"), r["p_type"].alias("name"), F.lit("STANDARD").alias("type")).alias("adGroup"),
            F.struct(s("l_partkey").alias("criterionId"),
                     F.struct(r["p_name"].alias("text"), F.lit("EXACT").alias("matchType")).alias("keyword")
                     ).alias("adGroupCriterion"),
            F.struct(r["l_returnflag"].alias("device"), r["l_linestatus"].alias("network"),
                     s("day").alias("date")).alias("segments"),
            F.struct((r["l_quantity"] * 100).cast("string").alias("impressions"),
                     s("l_quantity").alias("clicks"),
                     (r["l_linenumber"] - 1).cast("string").alias("conversions"),
                     (r["l_extendedprice"] * 1000000).cast("string").alias("costMicros"),
                     (r["l_extendedprice"] * (1 - r["l_discount"])).cast("string").alias("conversionsValue")
                     ).alias("metrics"))

    return _packed(j, result, F.floor(F.col("l_orderkey") / 100).alias("doc")).select("results")


def land_google(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``google_documents`` written to ``path``, compressed at gzip's usual level; the shuffle files of their making go
    when they are written. Rows are gathered after one sort by document, which may spill: maps of lists are given up
    after 128 documents, and the rows are sorted twice then."""
    own = isolated(spark, {**FREEING, "spark.sql.execution.useObjectHashAggregateExec": "false"})
    google_documents(own, sf_dir).write.option("compression", LANDED["compression"]).json(path)


def kakao_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    row = F.struct(F.col("o_custkey").cast("string").alias("keywordId"),
                   F.col("o_orderpriority").alias("adGroupId"),
                   F.struct((k % 1000).cast("string").alias("imp"), (k % 37).cast("string").alias("click"),
                            F.col("o_totalprice").cast("string").alias("spending"),
                            (k % 5).cast("string").alias("convPurchase1d"),
                            (k % 11).cast("string").alias("convPurchase7d")).alias("metrics"))
    day = F.col("o_orderdate").cast("date").cast("string")
    return (o.groupBy(F.col("o_orderstatus").alias("account_id"), day.alias("date"), F.floor(k / 100).alias("doc"))
             .agg(F.collect_list(row).alias("data"))
             .select("account_id", "date", (F.col("account_id") != FAILED_ACCOUNT).alias("ok"), "data"))


def account_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account-list document (its size is the number of accounts)."""
    o = table(spark, sf_dir, "orders")
    ids = o.select(F.col("o_orderstatus").alias("id")).distinct()
    return ids.agg(F.collect_list(F.struct("id")).alias("adAccounts"))


def master_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword master with a Korean label column, for the CSV round trip."""
    return kakao_master(spark, sf_dir).withColumn(
        "label", F.concat(F.lit(MASTER_LABEL_PREFIX), F.col("camp_name")))


def queue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue messages as landed by the queue (message id, body, attributes)."""
    from .fixtures import queue_messages
    q = queue_messages(spark, sf_dir)
    return q.select(F.col("event_id").cast("string").alias("message_id"), "body",
                    F.struct(F.col("receive_count").alias("ApproximateReceiveCount"),
                             F.col("sent_ms").alias("SentTimestamp")).alias("attributes"))


def received_documents(spark: SparkSession, sf_dir: str, days: int = 30) -> DataFrame:
    """``queue_documents`` with the time of first receipt: up to ``days`` days after the message was sent."""
    q = queue_documents(spark, sf_dir)
    wait = (F.col("message_id").cast("bigint") % days) * 86_400_000
    received = (F.col("attributes.SentTimestamp").try_cast("bigint") + wait).cast("string")
    return q.withColumn("attributes", F.col("attributes").withField("ApproximateFirstReceiveTimestamp", received))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries of the queue messages: a job succeeds at receive ``event_id % 5 + 1``, and a message that fails
    is delivered again five minutes later, three times in all."""
    from .fixtures import queue_messages
    q = queue_messages(spark, sf_dir)
    works = F.col("event_id") % 5 + 1
    receive = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(works, F.lit(3).cast("bigint"))))
    return q.select("event_id", "body", "sent", works.alias("works"), receive.alias("receive")).select(
        F.col("event_id").cast("string").alias("message_id"), "body", "receive",
        F.concat_ws("-", "event_id", "receive").alias("receipt"),
        (F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("sent"))
         + F.col("receive") * 300_000).alias("received_ms"), (F.col("receive") == F.col("works")).alias("ok"))


def google_day_documents(spark: SparkSession, sf_dir: str, scale_day: str | None = None) -> DataFrame:
    """Google responses with the extract day as a column (``date``), for a
    landing folder per day. With ``scale_day`` only that day's rows are
    produced, with impressions doubled (a rerun of that day)."""
    li = table(spark, sf_dir, "lineitem")
    pa = table(spark, sf_dir, "part")
    j = li.join(pa, li.l_partkey == pa.p_partkey).select(
        "l_orderkey", "p_brand", "p_type", "l_partkey", "p_name", F.col("l_shipdate").cast("date").cast("string").alias("date"),
        "l_quantity", "l_extendedprice", "l_discount")
    times = 100
    if scale_day is not None:
        j = j.filter(F.col("date") == scale_day)
        times = 200

    def result(r):
        return F.struct(
            F.struct(r["p_brand"].alias("name")).alias("campaign"),
            F.struct(r["p_type"].alias("name")).alias("adGroup"),
            F.struct(r["l_partkey"].cast("string").alias("criterionId"),
                     F.struct(r["p_name"].alias("text")).alias("keyword")).alias("adGroupCriterion"),
            F.struct(r["date"].alias("date")).alias("segments"),
            F.struct((r["l_quantity"] * times).cast("string").alias("impressions"), r["l_quantity"].cast("string").alias("clicks"),
                     (r["l_extendedprice"] * 1000000).cast("string").alias("costMicros"),
                     (r["l_extendedprice"] * (1 - r["l_discount"])).cast("string").alias("conversionsValue")
                     ).alias("metrics"))

    return _packed(j, result, "date", F.floor(F.col("l_orderkey") / 10_000).alias("doc")).select("date", "results")


def report_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weekly report document per week of the fact tables: a user
    request, assistant texts, and chart messages (a superseded pie, line,
    bar, table, the final pie, an empty pie and an unknown chart type); and
    one report without any dataset. The datasets hold what real ones do: a
    repeated media row, a row named by a text instead of a date, dates without
    zeros (Mondays in the table), and a campaign without a name beside one
    that bears the default name.

    One scan of the facts: a GROUPING SETS aggregate gives per-day sums of
    each media and per-campaign google sums in one pass; a second aggregate
    per week packs them into the datasets. Every dataset is bounded by the
    days, media and campaigns of a week, not by fact rows."""
    from ..functions.dates import week_start
    from ..functions.ratios import round_half_even
    from ..operators.sets import unify_media
    from .fixtures import google_ads, kakao_facts

    def by(field):
        return lambda a, b: F.when(a[field] < b[field], -1).when(a[field] > b[field], 1).otherwise(0)

    u = unify_media(google_ads(spark, sf_dir), kakao_facts(spark, sf_dir)).withColumn(
        "week", week_start("report_date"))
    g, k = F.col("media") == "google", F.col("media") == "kakao"

    def when_sum(cond, c):
        return F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    levels = (u.groupingSets([["week", "report_date"], ["week", "campaign"]], "week", "report_date", "campaign")
               .agg(when_sum(g, "cost").alias("gc"), when_sum(k, "cost").alias("kc"),
                    when_sum(g, "impressions").alias("gi"), when_sum(g, "clicks").alias("gk"),
                    when_sum(k, "impressions").alias("ki"), when_sum(k, "clicks").alias("kk"),
                    when_sum(g, "conversions").alias("gv"), when_sum(g, "conv_value").alias("gcv"),
                    F.count(F.when(g, 1)).alias("gn"), F.count(F.when(k, 1)).alias("kn"),
                    F.grouping("report_date").alias("_by_campaign")))
    s = lambda c: F.col(c).cast("string")
    r = {c: round_half_even(c, 0) for c in ["gc", "kc", "gcv"]}
    d = F.date_format("report_date", "yyyy-MM-dd")
    day_values = {"google_cost": r["gc"].cast("string"), "kakao_cost": r["kc"].cast("string"),
                  "google_impressions": s("gi"), "google_clicks": s("gk"),
                  "kakao_impressions": s("ki"), "kakao_clicks": s("kk")}
    camp_values = {"impressions": s("gi"), "clicks": s("gk"), "cost": r["gc"].cast("string"),
                   "conversions": s("gv"), "conv_value": r["gcv"].cast("string")}

    def as_map(first_key, first_value, keys, values):
        pairs = [F.lit(first_key), first_value]
        for name, key in keys.items():
            pairs += [F.lit(key), values[name]]
        return F.create_map(*pairs)
    line = as_map(L.KEY_DATE, d, L.LINE_KEYS, day_values)
    plain = F.when(F.weekday("report_date") == 0, F.date_format("report_date", "yyyy-M-d")).otherwise(d)
    tab = as_map(L.KEY_DATE, plain, L.TABLE_KEYS, day_values)
    bar = as_map(L.KEY_CAMPAIGN, F.col("campaign"), L.BAR_KEYS, camp_values)
    is_day = F.col("_by_campaign") == 0
    is_camp = (F.col("_by_campaign") == 1) & (F.col("gn") > 0)
    w = levels.groupBy("week").agg(
        F.array_sort(F.collect_list(F.when(is_day, F.struct("report_date", line.alias("m")))), by("report_date"))
         .alias("l"),
        F.array_sort(F.collect_list(F.when(is_day, F.struct("report_date", tab.alias("m")))), by("report_date"))
         .alias("t"),
        F.array_sort(F.collect_list(F.when(is_camp, F.struct("campaign", bar.alias("m")))), by("campaign"))
         .alias("b"),
        F.sum(F.when(is_day, F.col("gc"))).alias("g_cost"), F.sum(F.when(is_day, F.col("kc"))).alias("k_cost"),
        F.sum(F.when(is_day, F.col("gn"))).alias("g_n"), F.sum(F.when(is_day, F.col("kn"))).alias("k_n"),
        F.sum(F.when(is_day, F.col("gk"))).alias("clicks"))
    pie_row = lambda name, cost: F.create_map(F.lit(L.KEY_MEDIA), F.lit(name), F.lit(L.KEY_COST),
                                              round_half_even(cost, 0).cast("string"))
    pie = F.filter(F.array(F.when(F.col("g_n") > 0, pie_row(L.MEDIA_GOOGLE, "g_cost")),
                           F.when(F.col("k_n") > 0, pie_row(L.MEDIA_KAKAO, "k_cost"))), lambda x: x.isNotNull())
    num = lambda **kv: {**{k: F.lit("0") for k in L.TABLE_KEYS}, **{k: F.lit(v) for k, v in kv.items()}}
    sum_row = as_map(L.KEY_DATE, F.lit(SUM_LABEL), L.TABLE_KEYS, num(google_cost="5", google_clicks="1"))
    odd = {"impressions": "10", "clicks": "2", "cost": "3", "conversions": "1", "conv_value": "4"}
    no_name = F.create_map(*[F.lit(x) for k, v in odd.items() for x in (L.BAR_KEYS[k], v)])
    default = F.map_concat(F.create_map(F.lit(L.KEY_CAMPAIGN), F.lit(L.UNNAMED_CAMPAIGN)), no_name)
    again = F.create_map(F.lit(L.KEY_MEDIA), F.lit(L.MEDIA_GOOGLE), F.lit(L.KEY_COST), F.lit("7"))
    w = w.select("week", F.transform("l", lambda x: x["m"]).alias("line"),
                 F.concat(F.transform("t", lambda x: x["m"]), F.array(sum_row)).alias("table"),
                 F.concat(F.transform("b", lambda x: x["m"]), F.array(no_name, default)).alias("bar"),
                 F.concat(pie, F.array(again)).alias("pie"), "clicks")
    empty = F.array().cast("array<map<string,string>>")
    none = F.lit(None).cast("array<map<string,string>>")

    def msg(role, content, chart, data):
        return F.struct(F.lit(role).alias("role"), content.alias("content"),
                        (F.lit(chart) if chart else F.lit(None).cast("string")).alias("chartType"),
                        data.alias("structuredData"))
    zero_pie = F.transform(F.col("pie"), lambda x: F.transform_values(
        x, lambda key, v: F.when(key == L.KEY_COST, F.lit("0")).otherwise(v)))
    week_text = F.date_format("week", "yyyy-MM-dd")
    messages = F.array(
        msg("user", F.concat(F.lit("report for "), week_text), None, none),
        msg("assistant", F.concat(F.lit("week of "), week_text), None, none),
        msg("assistant", F.lit(""), "pie", zero_pie),
        msg("assistant", F.lit(""), "line", F.col("line")),
        msg("assistant", F.lit(""), "bar", F.coalesce(F.col("bar"), empty)),
        msg("assistant", F.lit(""), "table", F.col("table")),
        msg("assistant", F.lit(""), "pie", F.col("pie")),
        msg("assistant", F.lit(""), "pie", empty),
        msg("assistant", F.lit(""), "map", F.col("pie")),
        msg("assistant", F.concat(F.lit("google clicks "), F.col("clicks").cast("string")), None, none))
    weekly = w.select(F.concat(F.lit("w"), F.date_format("week", "yyyyMMdd")).alias("report_id"),
                      F.concat(F.lit(REPORT_TITLE_PREFIX), week_text).alias("title"),
                      F.date_format(F.date_add("week", 7), "yyyy-MM-dd'T'09:00:00").alias("createdAt"),
                      messages.alias("messages"))
    bare = table(spark, sf_dir, "region").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("empty").alias("report_id"), F.lit(REPORT_TITLE_PREFIX + "empty").alias("title"),
        F.lit("1998-12-31T23:30:00+09:00").alias("createdAt"),
        F.array(msg("assistant", F.concat(F.lit("no data in regions "), F.col("n").cast("string")), None, none)).alias("messages"))
    return weekly.unionByName(bare)


def keyword_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kakao keyword extract as CSV text rows (from events, with blanks,
    junk numbers and bad dates): kwd_id, adv_id, agroup_id, imp, click,
    spending, basic_date."""
    from .fixtures import raw_extract
    r = raw_extract(spark, sf_dir)
    return r.select((F.col("kwd_id").cast("bigint") % 2000).cast("string").alias("kwd_id"),
                    "adv_id", F.lit("g1").alias("agroup_id"), "imp", "click", "spending", "basic_date")


def google_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Google extract as CSV text rows; the segment ``date`` is a week after
    ``basic_date``, the date that reports go by."""
    from .fixtures import google_ads
    s = lambda c: F.col(c).cast("string").alias(c)
    return google_ads(spark, sf_dir).select(
        "camp_name", "keyword_id", "keyword_text", "basic_date",
        F.date_add("report_date", 7).cast("string").alias("date"), s("impressions"), s("clicks"), s("cost_micros"))


def master_in_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword master without a sequence column: the later row of a keyword
    stands later in the files. Carries the columns that the join drops."""
    m = kakao_master(spark, sf_dir).withColumn("adv_id", F.lit("master")).withColumn(
        "basic_date", F.lit("19000101")).withColumn("agroup_id", F.lit("master"))
    return m.repartitionByRange("seq", "kwd_id").sortWithinPartitions("seq", "kwd_id").drop("seq")


def kakao_padded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kakao responses whose keyword ids are those of the facts (some padded, some unknown)."""
    from .fixtures import kakao_facts
    f = kakao_facts(spark, sf_dir)
    row = F.struct(F.col("kwd_id").alias("keywordId"), F.col("agroup_id").alias("adGroupId"),
                   F.struct(*[F.col(c).cast("string").alias(n) for c, n in (
                       ("imp", "imp"), ("click", "click"), ("spending", "spending"),
                       ("conv_purchase_1d", "convPurchase1d"), ("conv_purchase_7d", "convPurchase7d"))]).alias("metrics"))
    day = F.col("report_date").cast("string")
    part = F.pmod(F.xxhash64("kwd_id", "imp", "click"), F.lit(64))
    return (f.groupBy(F.col("adv_id").alias("account_id"), day.alias("date"), part.alias("doc"))
             .agg(F.collect_list(row).alias("data"))
             .select("account_id", "date", (F.col("account_id") != FAILED_ACCOUNT).alias("ok"), "data"))

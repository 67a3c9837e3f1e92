"""Ad tables projected from the driver's tables.

The driver ships TPC-H-like tables, not ad data. These projections give the
ad-table shapes the operators read (the same projections are written as SQL
in ``adlens.oracle`` for the DuckDB check). They are plain select/join/union
plans, so Catalyst prunes columns and pushes date predicates into the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _date_text(ts: str):
    return F.regexp_replace(F.col(ts).cast("date").cast("string"), "-", "")


def google_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """google_ad_performance projection: lineitem x part."""
    li = table(spark, sf_dir, "lineitem")
    pa = table(spark, sf_dir, "part")
    j = li.join(pa, li.l_partkey == pa.p_partkey, "inner")
    return j.select(
        F.col("p_brand").alias("camp_name"),
        F.col("p_type").alias("agroup_name"),
        F.col("l_partkey").cast("string").alias("keyword_id"),
        F.col("p_name").alias("keyword_text"),
        F.col("l_returnflag").alias("device"),
        F.col("l_linestatus").alias("network_type"),
        _date_text("l_shipdate").alias("basic_date"),
        F.col("l_shipdate").cast("date").alias("report_date"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") < 10), F.lit(0).cast("bigint"))
         .otherwise(F.col("l_quantity").cast("bigint") * 100).alias("impressions"),
        F.col("l_quantity").cast("bigint").alias("clicks"),
        (F.col("l_extendedprice") * 1000000).alias("cost_micros"),
        (F.col("l_linenumber").cast("bigint") - 1).alias("conversions"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("conversions_value"),
    )


def kakao_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kakao_ad_performance keyword facts (before the master join): orders.
    Some keys are padded with spaces, some are in no master."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    kwd = c.cast("string")
    return o.select(
        F.when(c % 10 == 0, F.concat(F.lit("x"), kwd)).when(c % 10 == 1, F.concat(F.lit(" "), kwd, F.lit(" ")))
         .otherwise(kwd).alias("kwd_id"),
        F.col("o_orderpriority").alias("agroup_id"),
        F.col("o_orderstatus").alias("adv_id"),
        _date_text("o_orderdate").alias("basic_date"),
        F.col("o_orderdate").cast("date").alias("report_date"),
        (k % 1000).alias("imp"),
        (k % 37).alias("click"),
        F.col("o_totalprice").alias("spending"),
        (k % 5).alias("conv_purchase_1d"),
        (k % 11).alias("conv_purchase_7d"),
    )


def kakao_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword master with later duplicate rows: customer."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    first = c.select(
        key.cast("string").alias("kwd_id"), F.col("c_name").alias("kwd_name"),
        F.col("c_mktsegment").alias("camp_name"), F.lit(1).alias("seq"))
    second = c.filter(key % 7 == 0).select(
        key.cast("string").alias("kwd_id"), F.col("c_name").alias("kwd_name"),
        F.concat(F.col("c_mktsegment"), F.lit("_v2")).alias("camp_name"), F.lit(2).alias("seq"))
    return first.unionByName(second)


def queue_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue / dead-letter messages: events (bad text and messages without a
    platform included)."""
    e = table(spark, sf_dir, "events")
    t = F.col("event_type")
    body = (F.when(t == "click", F.lit('{"platform": "google"}'))
             .when(t == "view", F.lit('{"platform": "kakao"}'))
             .when(t == "error", F.lit("not json"))
             .otherwise(F.col("props")))
    rc = F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("string")) \
          .otherwise((F.lit(1) + F.col("event_id") % 3).cast("string"))
    ms = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    sent_ms = F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string")).otherwise(ms.cast("string"))
    return e.select("event_id", F.col("ts").alias("sent"), body.alias("body"),
                    rc.alias("receive_count"), sent_ms.alias("sent_ms"))


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat message items: conversations."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("message_id"),
        F.col("conv_id").cast("string").alias("conversation_id"),
        F.col("turn").alias("seq"), "role", F.col("text").alias("content"))


def raw_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyword extract with every field as text (bulk CSV / response
    values), from events: half values, blanks, junk, spaces, NaN, both date
    forms, unpadded dates and impossible dates."""
    e = table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id").cast("string")
    d = F.col("ts").cast("date")
    imp = (F.when(eid % 7 == 0, F.lit(None).cast("string")).when(eid % 7 == 1, F.lit(""))
            .when(eid % 7 == 2, F.lit("x")).when(eid % 7 == 3, F.concat(F.lit(" "), uid, F.lit(" ")))
            .when(eid % 7 == 4, F.lit("NaN")).otherwise(F.concat(uid, F.lit(".5"))))
    click = F.concat((eid % 13).cast("string"), F.lit("."), (eid % 10).cast("string"))
    spend = F.when(eid % 11 == 0, F.lit("-")).otherwise(
        F.concat((F.col("user_id") * 1000 + eid % 100).cast("string"), F.lit(".25")))
    date_text = (F.when(eid % 5 == 0, F.regexp_replace(d.cast("string"), "-", ""))
                  .when(eid % 5 == 1, d.cast("string"))
                  .when(eid % 5 == 2, F.concat_ws("-", F.year(d).cast("string"), F.month(d).cast("string"),
                                                  F.dayofmonth(d).cast("string")))
                  .when(eid % 5 == 3, F.concat(F.lit("2024-13-"), F.dayofmonth(d).cast("string")))
                  .otherwise(F.lit("")))
    adv = F.concat(uid, F.lit("-"), (eid % 1000).cast("string"))
    return e.select(eid.cast("string").alias("kwd_id"), adv.alias("adv_id"), imp.alias("imp"),
                    click.alias("click"), spend.alias("spending"), date_text.alias("basic_date"))


def user_of_conversation():
    """Owner of a conversation item (derived from its id)."""
    return F.concat(F.lit("u"), (F.col("conversation_id").cast("bigint") % 23).cast("string"))


def report_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved weekly report items: orders."""
    o = table(spark, sf_dir, "orders")
    created = F.col("o_orderdate")
    start = F.date_sub(created.cast("date"), F.weekday(created.cast("date")) + 7)
    return o.select(
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("report_id"),
        F.concat(F.lit("u"), (F.col("o_custkey") % 23).cast("string")).alias("user_id"),
        F.lit("weekly").alias("type"),
        start.alias("period_start"), F.date_add(start, 6).alias("period_end"),
        created.alias("created_at"))

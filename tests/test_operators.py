"""Operators: edge cases and properties (totals, shares, top-k, positions)."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from adlens.operators import aggregates as agg
from adlens.operators.joins import by_date_and_media, daily_lookup, enrich_with_master, latest_master, media_value
from adlens.operators.topk import first_groups, top_n
from adlens.session import scratch_path
from adlens.operators.windows import last_per_key, position_within, with_share
from adlens.plans import sheets


def test_master_last_sequence_wins(spark):
    m = spark.createDataFrame([(" k1", "old", 1), ("k1", "new", 2), ("k2", "only", 1)],
                              "kwd_id string, camp_name string, seq int")
    got = {r.kwd_id: r.camp_name for r in latest_master(m).collect()}
    assert got == {"k1": "new", "k2": "only"}


def test_null_keys_do_not_match(spark):
    f = spark.createDataFrame([(None, 1), ("a", 2)], "kwd_id string, imp long")
    m = spark.createDataFrame([(None, "x", 1), ("a", "y", 1)], "kwd_id string, camp_name string, seq int")
    got = sorted((r.imp, r.camp_name) for r in enrich_with_master(f, m, seq="seq").collect())
    assert got == [(1, None), (2, "y")]


def test_totals_row_equals_sum(spark):
    rnd = random.Random(7)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), float(rnd.randint(0, 1000)), rnd.randint(0, 99))
            for i in range(30)]
    df = spark.createDataFrame(rows, "report_date date, cost double, clicks long")
    out = agg.with_totals(df, ["report_date"], ["cost", "clicks"]).collect()
    total = [r for r in out if r.row_type == "total"]
    detail = [r for r in out if r.row_type == "detail"]
    assert len(total) == 1 and len(detail) == 30 and total[0].report_date is None
    assert total[0].cost == sum(r[1] for r in rows) and total[0].clicks == sum(r[2] for r in rows)


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([("google", 300.0), ("kakao", 100.0)], "media string, cost double")
    got = {r.media: r.share for r in with_share(df, "cost").collect()}
    assert got == {"google": 0.75, "kakao": 0.25}
    zero = spark.createDataFrame([("google", 0.0)], "media string, cost double")
    assert with_share(zero, "cost").first().share is None


def test_top_n_is_prefix_of_full_sort(spark):
    rnd = random.Random(3)
    rows = [(f"c{i:02d}", float(rnd.randint(0, 20))) for i in range(40)]
    df = spark.createDataFrame(rows, "camp_name string, v double")
    full = [r.camp_name for r in top_n(df, "v", "camp_name", None).collect()]
    top = [r.camp_name for r in top_n(df, "v", "camp_name", 10).collect()]
    assert top == full[:10]
    assert full == [c for c, _ in sorted(rows, key=lambda x: (-x[1], x[0]))]


def test_position_within_matches_brute_force_on_skewed_keys(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        k = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 50)}"
        rows.append((k, rnd.randint(0, 500), i))
    df = spark.createDataFrame(rows, "k string, v long, id long").repartition(6)
    got = {r.id: r.position for r in position_within(df, ["k"], [F.col("v").desc(), F.col("id")],
                                                     -F.floor(F.col("v") / 50)).collect()}
    w = Window.partitionBy("k").orderBy(F.col("v").desc(), F.col("id"))
    want = {r.id: r.p for r in df.select("id", F.row_number().over(w).alias("p")).collect()}
    assert got == want


def test_position_within_on_many_rows_with_null_keys_and_extra_columns(spark):
    """Past the sizes at which sampled partition bounds would differ: a hot
    key, a NULL key, and a column that only the rows carry."""
    n = 600_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None).cast("string"))
         .otherwise((F.col("id") % 1000).cast("string")).alias("k"),
        (F.hash("id") % 100_000).alias("v"), "id", F.concat(F.lit("text "), F.col("id")).alias("extra")).repartition(7)
    got = position_within(df, ["k"], [F.col("v"), F.col("id")], F.floor(F.col("v") / 1000))
    w = Window.partitionBy("k").orderBy("v", "id")
    both = got.withColumn("want", F.row_number().over(w)).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("want") != F.col("position")).cast("int")).alias("bad"),
        F.sum((F.col("extra") != F.concat(F.lit("text "), F.col("id"))).cast("int")).alias("mixed")).first()
    assert (both.n, both.bad, both.mixed) == (n, 0, 0)


def test_last_per_key_deterministic_on_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z")], "k string, seq int, v string")
    assert last_per_key(df, ["k"], "seq").first().v == "y"


def test_pivot_missing_side_is_zero(spark):
    u = spark.createDataFrame([(dt.date(2024, 1, 1), "google", 5.0), (dt.date(2024, 1, 2), "kakao", 7.0)],
                              "report_date date, media string, cost double")
    got = {r.report_date.day: (r.google_cost, r.kakao_cost) for r in by_date_and_media(u, ["cost"]).collect()}
    assert got == {1: (5.0, 0.0), 2: (0.0, 7.0)}


def test_daily_lookup_unmatched_counts_zero_and_last_row_wins(spark):
    daily = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)], "report_date date")
    table = spark.createDataFrame([(dt.date(2024, 1, 1), 10, 1), (dt.date(2024, 1, 1), 20, 2)],
                                  "report_date date, clicks int, pos int")
    got = {r.report_date.day: r.clicks for r in daily_lookup(daily, table, seq="pos").collect()}
    assert got == {1: 20, 2: 0}


def test_media_value_first_row_else_zero(spark):
    pie = spark.createDataFrame([("google", 5.0, 1), ("google", 9.0, 0)], "media string, cost double, pos int")
    assert media_value(pie, "google").first().cost == 9.0
    assert media_value(pie, "kakao").first().cost == 0.0


def test_media_totals_default_name(spark):
    pie = spark.createDataFrame([(None, 5.0, 2), ("google", 1.0, 0)], "media string, cost double, pos int")
    got = {r.media: r.cost for r in agg.media_totals(pie).collect()}
    assert got == {"매체3": 5.0, "google": 1.0}


def test_kpi_uses_table_when_pie_is_zero(spark):
    pie = spark.createDataFrame([("google", 0.0), ("kakao", 0.0)], "media string, cost double")
    table = spark.createDataFrame([(dt.date(2024, 1, 1), 10.0, 20.0, 100, 5, 50, 5)],
                                  "report_date date, google_cost double, kakao_cost double, google_impressions long, "
                                  "google_clicks long, kakao_impressions long, kakao_clicks long")
    got = {r.metric: r.value for r in sheets.kpi(pie, table).collect()}
    assert got["google_cost"] == 10.0 and got["kakao_cost"] == 20.0 and got["total_cost"] == 30.0
    assert got["avg_ctr"] == round(10 / 150, 4)


def _table(spark, dates_costs):
    return spark.createDataFrame(
        [(d, c, 0.0, 1, 1, 0, 0) for d, c in dates_costs],
        "report_date date, google_cost double, kakao_cost double, google_impressions long, google_clicks long, "
        "kakao_impressions long, kakao_clicks long")


def test_week_of_month_first_five_and_defaults(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * i) for i in range(6)]
    out = sheets.week_of_month(_table(spark, [(d, 10.0) for d in days])).orderBy("first_date").collect()
    assert [r.week_label for r in out] == ["1월 1주차", "1월 2주차", "1월 3주차", "1월 4주차", "1월 5주차"]
    assert abs(sum(r.share for r in out) - 1.0) < 1e-12
    empty = sheets.week_of_month(_table(spark, []).limit(0)).collect()
    assert sorted(r.week_label for r in empty) == ["W1", "W2", "W3", "W4", "W5"]


def test_first_groups(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "g string, pos int")
    assert [r.g for r in first_groups(df, "pos", 2).collect()] == ["a", "b"]


def test_kakao_preaggregated_path_equals_row_path(spark):
    from adlens.plans.weekly import WEEK_END, WEEK_START, kakao_top
    from adlens.sources import fixtures as fx

    from .conftest import SF
    facts, master = fx.kakao_facts(spark, SF), fx.kakao_master(spark, SF)
    rows = enrich_with_master(facts, master, seq="seq")
    by_rows = agg.kakao_campaign_summary(rows, WEEK_START, WEEK_END, n=None).collect()
    by_keyword = kakao_top(facts, master, n=None).collect()
    assert sorted(map(tuple, by_rows), key=str) == sorted(map(tuple, by_keyword), key=str)


def test_hot_key_left_join_is_split_by_aqe(spark):
    """A keyword holding most fact rows: with the master too large to
    broadcast, AQE splits the skewed join partition (results unchanged)."""
    facts = spark.range(60000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("kwd_id"),
        F.col("id").alias("imp"))
    master = spark.range(500).select(F.col("id").cast("string").alias("kwd_id"), F.lit("c").alias("camp_name"),
                                     F.lit(1).alias("seq")).unionByName(
        spark.range(1).select(F.lit("hot").alias("kwd_id"), F.lit("h").alias("camp_name"), F.lit(1).alias("seq")))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        path = scratch_path(spark, "one_master")
        latest_master(master, "seq").drop("seq").write.parquet(path)
        out = enrich_with_master(facts, spark.read.parquet(path))
        got = dict(out.groupBy("camp_name").count().collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == {"h": 40000, "c": 20000}
    assert "SortMergeJoin" in plan and "skew" in plan.lower()


def test_kpi_takes_the_first_pie_row_of_each_media_and_lists_empty_reports(spark):
    pie = spark.createDataFrame([("r", 0, "google", 100.0), ("r", 1, "google", 50.0), ("r", 2, "kakao", 7.0)],
                                "report_id string, pos int, media string, cost double")
    table = spark.createDataFrame([], "report_id string, report_date date, google_cost double, kakao_cost double, "
                                      "google_impressions long, google_clicks long, kakao_impressions long, kakao_clicks long")
    reports = spark.createDataFrame([("r",), ("empty",)], "report_id string")
    got = {(r.report_id, r.metric): r.value for r in sheets.kpi(pie, table, ("report_id",), reports).collect()}
    assert got["r", "google_cost"] == 100.0 and got["r", "kakao_cost"] == 7.0 and got["r", "total_cost"] == 107.0
    assert got["empty", "total_cost"] == 0.0 and got["empty", "avg_ctr"] == 0.0
    weeks = sheets.week_of_month(table, by=("report_id",), reports=reports).collect()
    assert sorted((r.report_id, r.week_label) for r in weeks) == sorted(
        (k, f"W{i}") for k in ("r", "empty") for i in range(1, 6))


def test_week_labels_from_document_text(spark):
    t = spark.createDataFrame([("r", 0, "2024-3-5", dt.date(2024, 3, 5)), ("r", 1, "3월 합", None), ("r", 2, "", None)],
                              "report_id string, pos int, date_text string, report_date date")
    t = t.select("*", *[F.lit(1.0).alias(c) for c in ("google_cost", "kakao_cost", "google_clicks", "kakao_clicks")])
    got = {r.week_label for r in sheets.week_of_month(t, by=("report_id",), pos="pos").collect()}
    assert got == {"3월 1주차", "3월 합", "기타"}


def test_totals_keep_rows_with_equal_names_apart(spark):
    df = spark.createDataFrame([("(미분류)", 5, 20, 0.25), ("(미분류)", 1, 10, 0.1), ("(미분류)", 1, 10, 0.1), ("a", 2, 4, 0.5)],
                               "campaign string, clicks long, impressions long, ctr double")
    out = agg.with_totals(df, ["campaign"], ["clicks", "impressions"], keep=["ctr"]).collect()
    detail = sorted((r.campaign, r.clicks, r.impressions, r.ctr) for r in out if r.row_type == "detail")
    assert detail == [("(미분류)", 1, 10, 0.1), ("(미분류)", 1, 10, 0.1), ("(미분류)", 5, 20, 0.25), ("a", 2, 4, 0.5)]
    (total,) = [r for r in out if r.row_type == "total"]
    assert (total.clicks, total.impressions, total.ctr, total.campaign) == (9, 44, None, None)


def test_padded_keys_match_in_both_paths(spark):
    facts = spark.createDataFrame([(" 1 ", dt.date(2024, 3, 5), 3, 1, 2.0, 0, 0), ("1", dt.date(2024, 3, 5), 4, 1, 2.0, 0, 0)],
                                  "kwd_id string, report_date date, imp long, click long, spending double, "
                                  "conv_purchase_1d long, conv_purchase_7d long")
    one = agg.kakao_keyword_totals(facts, "2024-03-01", "2024-03-31").collect()
    assert [(r.kwd_id, r.imp) for r in one] == [("1", 7)]


def test_summary_sheet_blocks_agree(spark):
    from adlens.catalog import AS_OF, _unified  # noqa: F401
    from adlens.plans.weekly import WEEK_END, WEEK_START

    from .conftest import SF
    s = sheets.summary_sheet(_unified(spark, SF), WEEK_START, WEEK_END)
    kpi = {r.metric: r.value for r in s["kpi"].collect()}
    pie = {r.media: (r.cost, r.share) for r in s["media_share"].collect()}
    assert kpi["google_cost"] == pie["google"][0] and kpi["kakao_cost"] == pie["kakao"][0]
    assert kpi["total_cost"] == pie["google"][0] + pie["kakao"][0]
    assert abs(pie["google"][1] + pie["kakao"][1] - 1.0) < 1e-12
    assert 1 <= s["weeks"].count() <= 5

"""Weekly report (RB9): top campaigns and totals of each media for the
week before an as-of instant, plus the single-table pieces (AG1, AG2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DEFAULT_TZ, display_date, in_range, last_week
from ..operators import aggregates as agg
from ..operators.joins import latest_master
from ..operators.topk import top_n

# Standard week used by the checked queries (inside the driver data range).
WEEK_START = "1998-03-02"
WEEK_END = "1998-03-08"


def google_top(google: DataFrame, start=WEEK_START, end=WEEK_END, n: int | None = 10) -> DataFrame:
    return agg.google_campaign_summary(google, start, end, n)


def kakao_top(facts: DataFrame, master: DataFrame, start=WEEK_START, end=WEEK_END,
              n: int | None = 10, seq: str = "seq") -> DataFrame:
    """AG2 over keyword facts enriched with the master (JN1, AG11).

    Facts are first summed per keyword for the range (map-side combined),
    then joined to the de-duplicated master, then summed per campaign:
    the join sees distinct keywords rather than every fact row."""
    per_kwd = agg.kakao_keyword_totals(facts, start, end)
    m = latest_master(master, seq).select("kwd_id", "camp_name")
    joined = per_kwd.join(m, on="kwd_id", how="left")
    camp = joined.groupBy("camp_name").agg(*agg.kakao_metrics())
    return top_n(camp, "cost", tie="camp_name", n=n)


def _top_and_total(per_camp: DataFrame, platform: str, order: str, n: int) -> DataFrame:
    """Top-n campaigns and the total row from one per-campaign aggregate of
    raw sums. Both branches read the same aggregate, so Spark reuses its
    shuffle and the facts are scanned once; the total is a sum over the
    (small) campaign rows, exact because the raw sums are exact."""
    top = top_n(agg.finalize(per_camp, platform, ["camp_name"]), order, tie="camp_name", n=n)
    total = agg.finalize(per_camp.agg(*agg.sum_again(platform)).withColumn("camp_name", F.lit(None).cast("string")),
                         platform, ["camp_name"])
    return (top.withColumn("section", F.lit(f"{platform}_top"))
               .unionByName(total.withColumn("section", F.lit(f"{platform}_total"))))


def weekly_report(google: DataFrame, kakao_facts: DataFrame, master: DataFrame, as_of,
                  tz: str = DEFAULT_TZ, n: int = 10, seq: str = "seq") -> DataFrame:
    """RB9 in one result: for the week before ``as_of`` (in ``tz``), the
    top-n campaigns and the overall totals of each media, with the period.
    One scan per fact table."""
    start, end = last_week(as_of, tz)
    gc = in_range(google, start, end).groupBy("camp_name").agg(*agg.raw_sums("google"))
    return from_sums(gc, agg.kakao_keyword_totals(kakao_facts, start, end), master, start, end, n, seq)


def from_sums(google_camps: DataFrame, kakao_keywords: DataFrame, master: DataFrame, start, end, n: int = 10,
              seq: str = "seq") -> DataFrame:
    """RB9 from the raw sums of the week: google's by campaign, kakao's by keyword."""
    g = (_top_and_total(google_camps, "google", "conversions_value", n)
         .withColumn("conversions_1d", F.lit(None).cast("bigint"))
         .withColumn("conversions_7d", F.lit(None).cast("bigint")))
    m = latest_master(master, seq).select("kwd_id", "camp_name")
    kc = kakao_keywords.join(m, on="kwd_id", how="left").groupBy("camp_name").agg(*agg.sum_again("kakao"))
    k = (_top_and_total(kc, "kakao", "cost", n)
         .withColumn("conversions", F.col("conversions_7d"))
         .withColumn("conversions_value", F.lit(None).cast("double"))
         .withColumn("cost_per_conversion", F.lit(None).cast("double")))
    cols = ["section", "camp_name", "impressions", "clicks", "ctr", "cost", "conversions", "conversions_value",
            "cost_per_conversion", "conversions_1d", "conversions_7d"]
    out = g.select(*cols).unionByName(k.select(*cols))
    return (out.withColumn("period_start", start).withColumn("period_end", end)
               .withColumn("period_start_text", display_date(start))
               .withColumn("period_end_text", display_date(end)))


__all__ = ["google_top", "kakao_top", "weekly_report", "WEEK_START", "WEEK_END"]

"""Aggregations (AG1-AG10, AG14, AG15).

All combine map-side, so a hot key (one campaign holding a third of all
rows, or the NULL campaign of unmatched keywords) is reduced inside each
task before the shuffle. Sums and counts are hash aggregates; the keep-last
and first-row ones (``max``/``min_by`` of packed rows) sort instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import in_range
from ..labels import DEFAULT_MEDIA_PREFIX
from ..functions.ratios import (count_sum, money_sum,
                                pct_half_up, round_half_up)
from .topk import top_n

# ---- weekly report metrics (SQL semantics: ROUND half-up, NULLIF guards)


def google_metrics() -> list[Column]:
    """AG1 / AG3 measures over google_ad_performance rows."""
    cost = F.sum(F.col("cost_micros").cast("decimal(38,0)"))
    return [
        count_sum("impressions").alias("impressions"),
        count_sum("clicks").alias("clicks"),
        pct_half_up(F.sum("clicks"), F.sum("impressions")).alias("ctr"),
        round_half_up(cost / F.lit(1000000), 0).alias("cost"),
        count_sum("conversions").alias("conversions"),
        round_half_up(money_sum("conversions_value"), 0).alias("conversions_value"),
        F.round(F.try_divide(cost.cast("double") / F.lit(1000000.0),
                             F.nullif(F.sum("conversions").cast("double"), F.lit(0.0))),
                0).alias("cost_per_conversion"),
    ]


def kakao_metrics() -> list[Column]:
    """AG2 / AG4 measures over kakao_ad_performance rows."""
    return [
        count_sum("imp").alias("impressions"),
        count_sum("click").alias("clicks"),
        pct_half_up(F.sum("click"), F.sum("imp")).alias("ctr"),
        round_half_up(money_sum("spending"), 0).alias("cost"),
        count_sum("conv_purchase_1d").alias("conversions_1d"),
        count_sum("conv_purchase_7d").alias("conversions_7d"),
    ]


GOOGLE_RAW = ["impressions", "clicks", "cost_micros", "conversions", "conversions_value"]
KAKAO_RAW = ["imp", "click", "spending", "conv_purchase_1d", "conv_purchase_7d"]


def raw_sums(platform: str) -> list[Column]:
    """Exact per-group sums that the report metrics are derived from; sums
    of these sums are again exact, so totals can be taken from groups."""
    if platform == "google":
        return [count_sum("impressions").alias("impressions"), count_sum("clicks").alias("clicks"),
                F.sum(F.col("cost_micros").cast("decimal(38,0)")).alias("cost_micros"),
                count_sum("conversions").alias("conversions"),
                money_sum("conversions_value").alias("conversions_value")]
    return [count_sum("imp").alias("imp"), count_sum("click").alias("click"),
            money_sum("spending").alias("spending"),
            count_sum("conv_purchase_1d").alias("conv_purchase_1d"),
            count_sum("conv_purchase_7d").alias("conv_purchase_7d")]


def sum_again(platform: str) -> list[Column]:
    cols = GOOGLE_RAW if platform == "google" else KAKAO_RAW
    return [F.sum(c).alias(c) for c in cols]


def finalize(df: DataFrame, platform: str, keys: list[str]) -> DataFrame:
    """Report metrics from raw sums (same values as google_metrics /
    kakao_metrics applied to the rows)."""
    if platform == "google":
        cost = F.col("cost_micros")
        return df.select(
            *keys, "impressions", "clicks", pct_half_up(F.col("clicks"), F.col("impressions")).alias("ctr"),
            round_half_up(cost / F.lit(1000000), 0).alias("cost"), "conversions",
            round_half_up(F.col("conversions_value"), 0).alias("conversions_value"),
            F.round(F.try_divide(cost.cast("double") / F.lit(1000000.0),
                                 F.nullif(F.col("conversions").cast("double"), F.lit(0.0))), 0)
             .alias("cost_per_conversion"))
    return df.select(
        *keys, F.col("imp").alias("impressions"), F.col("click").alias("clicks"),
        pct_half_up(F.col("click"), F.col("imp")).alias("ctr"),
        round_half_up(F.col("spending"), 0).alias("cost"),
        F.col("conv_purchase_1d").alias("conversions_1d"), F.col("conv_purchase_7d").alias("conversions_7d"))


def google_campaign_summary(google: DataFrame, start, end, n: int | None = 10) -> DataFrame:
    """AG1 + TK1: per campaign, top ``n`` by conversion value."""
    g = in_range(google, start, end).groupBy("camp_name").agg(*google_metrics())
    return top_n(g, "conversions_value", tie="camp_name", n=n)


def kakao_campaign_summary(kakao: DataFrame, start, end, n: int | None = 10) -> DataFrame:
    """AG2 + TK2: per campaign (enriched rows), top ``n`` by spend."""
    k = in_range(kakao, start, end).groupBy("camp_name").agg(*kakao_metrics())
    return top_n(k, "cost", tie="camp_name", n=n)


KAKAO_SUM_COLUMNS = ["imp", "click", "conv_purchase_1d", "conv_purchase_7d"]


def kakao_keyword_totals(facts: DataFrame, start, end) -> DataFrame:
    """Pre-aggregation of keyword facts to one row per keyword for the range:
    the join with the master then sees distinct keywords, not raw rows."""
    f = in_range(facts, start, end).withColumn("kwd_id", F.trim(F.col("kwd_id")))
    return f.groupBy("kwd_id").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in KAKAO_SUM_COLUMNS],
        money_sum("spending").alias("spending"))


def overall(fact: DataFrame, media: str, start, end) -> DataFrame:
    """AG3 / AG4: one row of totals (a row of NULLs on empty input)."""
    f = in_range(fact, start, end)
    if media == "google":
        cost = F.sum(F.col("cost_micros").cast("decimal(38,0)"))
        return f.agg(F.lit("google").alias("media"),
                     count_sum("impressions").alias("impressions"),
                     count_sum("clicks").alias("clicks"),
                     round_half_up(cost / F.lit(1000000), 0).alias("cost"),
                     count_sum("conversions").alias("conversions"),
                     round_half_up(money_sum("conversions_value"), 0).alias("conversions_value"))
    return f.agg(F.lit("kakao").alias("media"),
                 count_sum("imp").alias("impressions"),
                 count_sum("click").alias("clicks"),
                 round_half_up(money_sum("spending"), 0).alias("cost"),
                 count_sum("conv_purchase_7d").alias("conversions"),
                 F.lit(None).cast("double").alias("conversions_value"))


def overall_by_media(google: DataFrame, kakao: DataFrame, start, end) -> DataFrame:
    """AG5: AG3 and AG4 keyed by media."""
    return overall(google, "google", start, end).unionByName(overall(kakao, "kakao", start, end))


# ---- report-table aggregates


def with_totals(df: DataFrame, keys: list[str], sums: list[str],
                keep: list[str] | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """AG9: detail rows plus a totals row (per ``within`` keys, e.g. one per
    report; else one grand total), from one GROUPING SETS with these two
    levels only. Every detail row stays a row of its own, also when keys are
    equal: all its columns are grouped by. ``row_type`` comes from
    grouping_id(), not from a label. Columns in ``keep`` are carried on
    detail rows and NULL on totals."""
    keep = keep or []
    within = tuple(within)
    # equal detail rows are counted, then listed again
    shown = [*keys, *keep, *[f"_{c}" for c in sums]]
    rows = df.select(*within, *keys, *keep, *sums, *[F.col(c).alias(f"_{c}") for c in sums])
    g = (rows.groupingSets([[*within, *shown], list(within)], *within, *shown)
             .agg(*[F.sum(c).alias(c) for c in sums], F.count(F.lit(1)).alias("_n"),
                  F.grouping(keys[0]).alias("_g")))
    total = F.col("_g") != 0
    one = [F.when(total, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in sums]
    return (g.select(*within, *keys, *one, *keep, F.when(total, F.lit("total")).otherwise(F.lit("detail")).alias("row_type"),
                     F.explode(F.when(total, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), F.col("_n").cast("int")))).alias("_i"))
             .drop("_i"))


def media_totals(pie: DataFrame, media: str = "media", value: str = "cost",
                 pos: str = "pos", default_prefix: str = DEFAULT_MEDIA_PREFIX) -> DataFrame:
    """AG10: cost per media; a row without a media name is named
    ``매체N`` (N = its 1-based position)."""
    name = F.coalesce(F.col(media), F.concat(F.lit(default_prefix), (F.col(pos) + 1).cast("string")))
    return (pie.select(name.alias(media), F.col(value), F.col(pos))
               .groupBy(media).agg(F.sum(value).alias(value), F.min(pos).alias(pos)))


def failed_counts(messages: DataFrame, platform: str = "platform") -> DataFrame:
    """AG14: failed-message count per platform."""
    return messages.groupBy(platform).agg(F.count(F.lit(1)).alias("n"))


def observed(df: DataFrame, name: str):
    """AG15: row count of a stage as an observed metric, collected by the
    action that runs the plan anyway (no extra job). Returns the frame to
    keep using and the Observation; ``obs.get["rows"]`` after the action."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs

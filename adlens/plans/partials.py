"""Reports and the dashboard from stored daily sums (RB1, RB2, RB4, RB9, RB10, AG1-AG5, WN4).

A table of sums holds, for every day, the exact raw sums of each campaign
(google) or keyword (kakao, whose campaigns come from a master that changes).
Sums of sums are exact, so a report over stored sums equals the report over
the facts. The table has a folder per day: a load refreshes the days that it
has written and no others, and a report lists and reads the days of its range
only, whatever the size of the fact table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import DEFAULT_TZ, last_week, local_date, week_start
from ..functions.ratios import round_half_up
from ..operators import aggregates as agg
from ..operators.sets import unify_media
from ..session import existing
from ..sinks.tables import write_partitions
from ..sources.readers import scan_table
from . import dashboard, sheets, weekly

#: What the sums of each media are kept by.
KEYS = {"google": "camp_name", "kakao": "kwd_id"}
#: Columns of the stored tables.
SCHEMAS = {
    "google": "camp_name string, impressions bigint, clicks bigint, cost_micros decimal(38,0), conversions bigint, "
              "conversions_value decimal(38,6), report_date date",
    "kakao": "kwd_id string, imp bigint, click bigint, spending decimal(38,6), conv_purchase_1d bigint, "
             "conv_purchase_7d bigint, report_date date",
}


def daily_sums(facts: DataFrame, platform: str) -> DataFrame:
    """The raw sums of every day; combined in the tasks before the shuffle."""
    key = F.trim(F.col("kwd_id")).alias("kwd_id") if platform == "kakao" else F.col("camp_name")
    sums = facts.where(F.col("report_date").isNotNull()).groupBy("report_date", key).agg(*agg.raw_sums(platform))
    names = [c.split()[0] for c in SCHEMAS[platform].split(", ")]
    types = dict(c.split(" ") for c in SCHEMAS[platform].split(", "))
    return sums.select(*[F.col(c).cast(types[c]).alias(c) for c in names])


def refresh(facts: DataFrame, platform: str, path: str) -> None:
    """Replace the sums of the days in ``facts``, which holds all rows of these days."""
    write_partitions(daily_sums(facts, platform), path, keys=("report_date",))


def refresh_days(spark: SparkSession, table: str, platform: str, path: str, days: DataFrame) -> None:
    """Bring the sums of ``days`` (report_date: what a load has rewritten) up to the fact table; only the folders of
    these days are read. The days of a load reach the driver, one row each."""
    for first, last in _ranges(sorted(r[0] for r in days.select("report_date").distinct().collect() if r[0])):
        refresh(scan_table(spark, table, platform, str(first), str(last)), platform, path)


def _ranges(days: list[_dt.date]) -> list[tuple[_dt.date, _dt.date]]:
    """Runs of consecutive days."""
    out: list[tuple[_dt.date, _dt.date]] = []
    for d in days:
        if out and d - out[-1][1] == _dt.timedelta(days=1):
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


def stored(spark: SparkSession, path: str, platform: str, start: str, end: str) -> DataFrame:
    """The sums of a range of days (``yyyy-MM-dd``): one row a key and day; reads the folders of these days."""
    first, last = _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)
    months = sorted({(first + _dt.timedelta(days=i)).strftime("%Y-%m") for i in range((last - first).days + 1)})
    found = [p for m in months for p in existing(spark, f"{path}/report_date={m}-*") if start <= p[-10:] <= end]
    if not found:
        return spark.createDataFrame([], SCHEMAS[platform])
    return spark.read.schema(SCHEMAS[platform]).option("basePath", path).parquet(*found)


def range_sums(spark: SparkSession, path: str, platform: str, start: str, end: str) -> DataFrame:
    """The sums of the range by campaign or keyword."""
    return stored(spark, path, platform, start, end).groupBy(KEYS[platform]).agg(*agg.sum_again(platform))


def _days(spark: SparkSession, first, last) -> tuple[str, str]:
    r = spark.range(1).select(first.cast("string").alias("a"), last.cast("string").alias("b")).first()
    return r["a"], r["b"]


def weekly_report(spark: SparkSession, root: str, master: DataFrame, as_of, tz: str = DEFAULT_TZ, n: int = 10,
                  seq: str = "seq") -> DataFrame:
    """RB9 from the sums under ``root/google`` and ``root/kakao``: the seven days before the week of ``as_of``."""
    first, last = _days(spark, *last_week(as_of, tz))
    return weekly.from_sums(range_sums(spark, f"{root}/google", "google", first, last),
                            range_sums(spark, f"{root}/kakao", "kakao", first, last), master, *last_week(as_of, tz), n, seq)


def campaign_top(spark: SparkSession, root: str, start: str, end: str, n: int | None = 10) -> DataFrame:
    """AG1 + TK1 from stored sums."""
    from ..operators.topk import top_n
    camps = agg.finalize(range_sums(spark, f"{root}/google", "google", start, end), "google", ["camp_name"])
    return top_n(camps, "conversions_value", tie="camp_name", n=n)


def overall_by_media(spark: SparkSession, root: str, start: str, end: str) -> DataFrame:
    """AG3-AG5 from stored sums."""
    g = stored(spark, f"{root}/google", "google", start, end).agg(*agg.sum_again("google")).select(
        F.lit("google").alias("media"), "impressions", "clicks",
        round_half_up(F.col("cost_micros") / F.lit(1000000), 0).alias("cost"), "conversions",
        round_half_up(F.col("conversions_value"), 0).alias("conversions_value"))
    k = stored(spark, f"{root}/kakao", "kakao", start, end).agg(*agg.sum_again("kakao")).select(
        F.lit("kakao").alias("media"), F.col("imp").alias("impressions"), F.col("click").alias("clicks"),
        round_half_up(F.col("spending"), 0).alias("cost"), F.col("conv_purchase_7d").alias("conversions"),
        F.lit(None).cast("double").alias("conversions_value"))
    return g.unionByName(k)


def unified(spark: SparkSession, root: str, start: str, end: str) -> DataFrame:
    """SO2 over the stored sums of a range: what the unified facts sum up to by day and media, for every table that
    needs no keyword (a row a day and campaign of google, a row a day and keyword of kakao)."""
    return unify_media(stored(spark, f"{root}/google", "google", start, end),
                       stored(spark, f"{root}/kakao", "kakao", start, end))


def dashboard_media(spark: SparkSession, root: str, as_of, tz: str = DEFAULT_TZ) -> DataFrame:
    """RB10 from the stored sums of Monday to today."""
    today = local_date(as_of, tz)
    return dashboard.dashboard_media(unified(spark, root, *_days(spark, week_start(today), today)), as_of, tz)


def conversion_trend(spark: SparkSession, root: str, as_of, tz: str = DEFAULT_TZ, days: int = 7) -> DataFrame:
    """RB10's trend from the stored sums of its days."""
    today = local_date(as_of, tz)
    rows = unified(spark, root, *_days(spark, F.date_sub(today, days - 1), today))
    return dashboard.conversion_trend(rows, as_of, tz, days)


def daily_sheet(spark: SparkSession, root: str, start: str, end: str) -> DataFrame:
    """RB2 + RB4 with the totals row, from stored sums."""
    return sheets.daily_sheet(unified(spark, root, start, end), start, end)


def media_spend(spark: SparkSession, root: str, start: str, end: str) -> DataFrame:
    """RB1 from stored sums."""
    return sheets.media_spend(unified(spark, root, start, end), start, end)


def week_over_week(spark: SparkSession, root: str, as_of, tz: str = DEFAULT_TZ) -> DataFrame:
    """WN4 from the stored sums of the last two whole weeks."""
    start, end = last_week(as_of, tz)
    rows = unified(spark, root, *_days(spark, F.date_sub(start, 7), end))
    return sheets.week_over_week_as_of(rows, as_of, tz)

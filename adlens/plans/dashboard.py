"""Dashboard figures (RB10): today's and this week's spend, ROAS, CPC, CTR
and spend share per media, and a 7-day conversion trend on a date spine."""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import DEFAULT_TZ, in_range, local_date, week_start
from ..functions.ratios import count_sum, money_sum, pct_half_up, round_half_even, safe_div
from ..operators.windows import with_share
from ..session import existing, path_exists
from ..sources.readers import day_folders


def dashboard_media(unified: DataFrame, as_of, tz: str = DEFAULT_TZ) -> DataFrame:
    """Per media: today's spend, week-to-date spend (Monday..today), ROAS,
    CPC, CTR and share of the week's spend."""
    today = local_date(as_of, tz)
    monday = week_start(today)
    f = in_range(unified, monday, today)
    is_today = F.col("report_date") == today
    a = f.groupBy("media").agg(
        round_half_even(F.sum(F.when(is_today, F.col("cost")).otherwise(F.lit(0))), 0).alias("today_cost"),
        round_half_even(money_sum("cost"), 0).alias("week_cost"),
        round_half_even(money_sum("conv_value"), 0).alias("week_conv_value"),
        count_sum("impressions").alias("impressions"), count_sum("clicks").alias("clicks"))
    out = a.select("media", "today_cost", "week_cost",
                   safe_div("week_conv_value", "week_cost").alias("roas"),
                   safe_div("week_cost", "clicks").alias("cpc"),
                   pct_half_up(F.col("clicks"), F.col("impressions")).alias("ctr"))
    return with_share(out, "week_cost", "share")


def conversion_trend(unified: DataFrame, as_of, tz: str = DEFAULT_TZ, days: int = 7) -> DataFrame:
    """Conversions per day for the ``days`` days ending ``as_of`` (local);
    days without rows show 0 (a generated date spine left-joined to the
    per-day sums, both at most ``days`` rows)."""
    today = local_date(as_of, tz)
    first = F.date_sub(today, days - 1)
    f = in_range(unified, first, today)
    per_day = f.groupBy("report_date").agg(
        count_sum("conversions").alias("conversions"),
        round_half_even(money_sum("cost"), 0).alias("cost"))
    spine = unified.sparkSession.range(1).select(F.explode(F.sequence(first, today)).alias("report_date"))
    return (spine.join(per_day, "report_date", "left")
                 .select("report_date",
                         F.coalesce(F.col("conversions"), F.lit(0).cast("bigint")).alias("conversions"),
                         F.coalesce(F.col("cost"), F.lit(0.0)).alias("cost")))


def cached_dashboard(spark, unified_fn, as_of, root: str, source: str, tz: str = DEFAULT_TZ) -> DataFrame:
    """Dashboard figures materialised per input, time zone and as-of hour
    under ``root`` (a shared folder): the first request in an hour computes
    and writes them, later ones read the saved table. ``source`` names the
    input and its version; ``unified_fn()`` builds it only when needed. A
    table whose write did not finish (no ``_SUCCESS``) is written again.
    Expiry of old hours is left to the storage lifecycle."""
    hour = str(as_of)[:13].replace("-", "").replace(" ", "").replace("T", "")
    zone, name = (re.sub(r"[^A-Za-z0-9]", "_", x) for x in (tz, source))
    mark = hashlib.sha256(f"{tz}\n{source}".encode()).hexdigest()[:12]
    path = f"{root.rstrip('/')}/source={name[-40:]}-{mark}/tz={zone}/as_of_hour={hour}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        dashboard_media(unified_fn(), as_of, tz).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def days_version(spark, table: str, start: str, end: str) -> str:
    """Digest of the files (name, size, time of change) in a table's day folders from ``start`` to ``end``."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf, told = spark.sparkContext._jsc.hadoopConfiguration(), []
    for folder in day_folders(spark, table, start, end):
        p = fs_path(folder)
        told += [f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in p.getFileSystem(conf).listStatus(p)]
    return hashlib.sha256("\n".join(sorted(told)).encode()).hexdigest()[:16]


def cached_by_version(spark, table: str, as_of, root: str, tz: str = DEFAULT_TZ) -> DataFrame:
    """Dashboard figures of a unified table stored by day, kept for one hour of ``as_of`` and one version of the days
    that they read (the week up to today): a rewritten day makes a new version.

    A writer fills a folder of its own, which counts when it is complete
    (``_SUCCESS``); of several, written at once, all read the one with the
    least name, which holds the same figures as the others."""
    today = local_date(as_of, tz)
    r = spark.range(1).select(week_start(today).cast("string").alias("a"), today.cast("string").alias("b")).first()
    hour = re.sub(r"[^0-9]", "", str(as_of)[:13])
    zone = re.sub(r"[^A-Za-z0-9]", "_", tz)
    at = f"{root.rstrip('/')}/tz={zone}/as_of_hour={hour}/version={days_version(spark, table, r['a'], r['b'])}"

    def whole() -> list[str]:
        return sorted(p.rsplit("/", 1)[0] for p in existing(spark, f"{at}/run=*/_SUCCESS"))

    if not whole():
        days = day_folders(spark, table, r["a"], r["b"])
        if not days:
            raise ValueError(f"{table} has no days from {r['a']} to {r['b']}")
        unified = spark.read.option("basePath", table).parquet(*days)
        dashboard_media(unified, as_of, tz).write.parquet(f"{at}/run={uuid.uuid4().hex}")
    return spark.read.parquet(whole()[0])

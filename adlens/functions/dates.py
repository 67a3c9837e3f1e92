"""Date handling (SC5, SC6, SC7, SC8, SC9, SC11, SC15, PF12, PF13).

Everything here is independent of ``spark.sql.session.timeZone``: instants
are carried as timestamp_ntz in UTC and shifted with ``convert_timezone``,
which works on wall-clock values only.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..labels import (DATE_TEXT_PATTERN, DEFAULT_TZ, DISPLAY_DATE_PATTERN, WEEK_FALLBACK,  # noqa: F401
                      WEEK_MONTH_SUFFIX, WEEK_SUFFIX)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_report_date(col) -> Column:
    """SC5: ``yyyyMMdd`` or ``yyyy-M-d`` text to DATE, else NULL.

    Both text forms written by the two ingest paths land on one DATE
    column, so range filters work on either (deviation Q1)."""
    c = F.trim(_c(col).cast("string"))
    return F.coalesce(F.try_to_date(c, "yyyyMMdd"),
                      F.try_to_date(c, "yyyy-M-d"))


def compact_date_text(col) -> Column:
    """DATE to ``yyyyMMdd`` text."""
    return F.date_format(_c(col), "yyyyMMdd")


def dashed_date_text(col) -> Column:
    """DATE to ``yyyy-MM-dd`` text."""
    return F.date_format(_c(col), "yyyy-MM-dd")


def partition_keys(date_col) -> list[Column]:
    """year / month_p / day partition strings, zero padded."""
    d = _c(date_col)
    # integer parts padded with zeros: same strings as date_format, cheaper
    return [F.lpad(F.year(d).cast("string"), 4, "0").alias("year"),
            F.lpad(F.month(d).cast("string"), 2, "0").alias("month_p"),
            F.lpad(F.dayofmonth(d).cast("string"), 2, "0").alias("day")]


def partition_date(prefix: str = "") -> Column:
    """The partition strings back to a DATE, for partition pruning."""
    return F.make_date(F.col(prefix + "year").cast("int"),
                       F.col(prefix + "month_p").cast("int"),
                       F.col(prefix + "day").cast("int"))


def _as_ntz_literal(as_of) -> Column:
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def local_date(as_of, tz: str = DEFAULT_TZ) -> Column:
    """Calendar date of a UTC instant in ``tz``."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), _as_ntz_literal(as_of)))


def yesterday(as_of, tz: str = DEFAULT_TZ) -> Column:
    """SC8: the day before ``as_of`` in ``tz``."""
    return F.date_sub(local_date(as_of, tz), 1)


def last_week(as_of, tz: str = DEFAULT_TZ) -> tuple[Column, Column]:
    """SC8: Monday..Sunday of the week before ``as_of`` in ``tz``."""
    d = local_date(as_of, tz)
    start = F.date_sub(d, F.weekday(d) + 7)
    return start, F.date_add(start, 6)


def week_start(col) -> Column:
    """Monday of the week that holds the date."""
    d = _c(col)
    return F.date_sub(d, F.weekday(d))


def in_range(df: DataFrame, start, end, col: str = "report_date") -> DataFrame:
    """PF12: inclusive date range. On a table stored by year/month_p/day the
    same bounds are also applied to the partition columns, so they show up
    under PartitionFilters."""
    s = start if isinstance(start, Column) else F.lit(start).cast("date")
    e = end if isinstance(end, Column) else F.lit(end).cast("date")
    cond = F.col(col).between(s, e)
    if {"year", "month_p", "day"} <= set(df.columns):
        cond = cond & partition_date().between(s, e)
    return df.filter(cond)


def on_day(df: DataFrame, day, col: str = "report_date") -> DataFrame:
    """PF13: single-day predicate."""
    return in_range(df, day, day, col)


def week_of_month_label(date_text) -> Column:
    """SC7: ``M월 N주차`` from ``yyyy-M-d`` text (padded or not) with week =
    (day-1) div 7 + 1; unreadable text is kept as the label; empty or missing
    text is ``기타``."""
    t = _c(date_text).cast("string")
    d = F.try_to_date(t, "yyyy-M-d")
    wk = F.floor((F.dayofmonth(d) - 1) / 7) + 1
    label = F.concat(F.month(d).cast("string"), F.lit(WEEK_MONTH_SUFFIX),
                     wk.cast("string"), F.lit(WEEK_SUFFIX))
    return (F.when(d.isNotNull(), label)
             .when(F.coalesce(t, F.lit("")) == "", F.lit(WEEK_FALLBACK))
             .otherwise(t))


def display_date(col) -> Column:
    """SC9: ``YYYY년 MM월 DD일`` from an ISO timestamp text or a date: the
    wall-clock date that the text shows, whatever its UTC offset and the
    session time zone; text that does not parse falls back to its first 10
    characters."""
    c = _c(col).cast("string")
    # the offset names another clock, not another written date
    wall = F.regexp_replace(F.trim(c), r"(\d)\s*(Z|z|[+-]\d{2}:?(\d{2})?)$", "$1")
    wall = F.when(F.trim(c).rlike(r"\d[T ]\d"), wall).otherwise(F.trim(c))
    return F.coalesce(F.date_format(wall.try_cast("timestamp_ntz"), DISPLAY_DATE_PATTERN),
                      F.substring(c, 1, 10))


def epoch_ms_text_to_time(col, tz: str = "UTC",
                          fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """SC11: epoch milliseconds as text to local time text, else 'unknown'."""
    ms = _c(col).try_cast("bigint")
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (ms.cast("decimal(20,0)") / F.lit(1000)).cast("decimal(18,6)"))
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    return F.coalesce(F.date_format(local, fmt), F.lit("unknown"))


def date_like(col) -> Column:
    """SC6 predicate: text shaped ``yyyy-MM-dd``."""
    return _c(col).rlike(DATE_TEXT_PATTERN)


def find_date(map_col) -> Column:
    """SC6: first value of a row map that looks like a date, else the
    ``date`` entry, else ``basic_date``, else 'unknown'."""
    m = _c(map_col)
    hits = F.filter(F.map_values(m), lambda v: v.rlike(DATE_TEXT_PATTERN))
    return F.coalesce(F.try_element_at(hits, F.lit(1)),
                      F.try_element_at(m, F.lit("date")),
                      F.try_element_at(m, F.lit("basic_date")),
                      F.lit("unknown"))


def plus_days(col, days: int = 90) -> Column:
    """SC15: expiry = created + N days."""
    return _c(col) + F.make_dt_interval(F.lit(days))

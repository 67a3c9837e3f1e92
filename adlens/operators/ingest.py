"""Ingest typing (PF1-PF11, SC2, SC5): raw extracts to fact-table rows.

Two paths, as in the reference:
- bulk (CSV, every field text): nullable bigint with half-even rounding,
  nullable double, and the date rewritten to ``yyyy-MM-dd`` (Q4);
- batch (landed API responses): missing text '', missing numbers 0,
  integers truncated, and the date kept as ``yyyyMMdd`` (PF9).
Both add ``report_date`` (one DATE for either text form, Q1) and the
``year / month_p / day`` partition strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import (double_or_null, double_or_zero, long_half_even,
                               long_trunc_or_zero, text_or_empty)
from ..functions.dates import compact_date_text, dashed_date_text, parse_report_date, partition_keys
from ..schemas import GOOGLE_DOUBLES, GOOGLE_LONGS, KAKAO_DOUBLES, KAKAO_LONGS


def _numeric(platform: str):
    if platform == "google":
        return GOOGLE_LONGS, GOOGLE_DOUBLES
    if platform == "kakao":
        return KAKAO_LONGS, KAKAO_DOUBLES
    raise ValueError(f"unknown platform {platform!r}")


def type_bulk(df: DataFrame, platform: str, date_col: str | None = None) -> DataFrame:
    """Bulk CSV typing. Only columns present are typed (PF8); the date
    source is ``basic_date``, which the reports filter on (google extracts
    without one: ``date``)."""
    longs, doubles = _numeric(platform)
    date_col = date_col or ("basic_date" if "basic_date" in df.columns or platform == "kakao" else "date")
    out = []
    for c in df.columns:
        if c in longs:
            out.append(long_half_even(c).alias(c))
        elif c in doubles:
            out.append(double_or_null(c).alias(c))
        else:
            out.append(F.col(c))
    typed = df.select(*out, parse_report_date(date_col).alias("report_date"))
    if platform == "kakao" and "basic_date" in df.columns:
        # the bulk path rewrites kakao basic_date to yyyy-MM-dd
        typed = typed.withColumn("basic_date", dashed_date_text("report_date"))
    return typed.select("*", *partition_keys("report_date"))


def type_batch(df: DataFrame, platform: str, date_col: str = "basic_date",
               passthrough: tuple[str, ...] = ()) -> DataFrame:
    """Batch (response) typing: '' for missing text, 0 / 0.0 for missing
    numbers, integers truncated toward zero; dashes removed from ids."""
    longs, doubles = _numeric(platform)
    out = []
    for c in df.columns:
        if c in passthrough:
            out.append(F.col(c))
        elif c in longs:
            out.append(long_trunc_or_zero(c).alias(c))
        elif c in doubles:
            out.append(double_or_zero(c).alias(c))
        elif c == "adv_id":
            out.append(F.regexp_replace(text_or_empty(c), "-", "").alias(c))
        else:
            out.append(text_or_empty(c).alias(c))
    typed = df.select(*out, parse_report_date(date_col).alias("report_date"))
    typed = typed.withColumn(date_col, F.coalesce(compact_date_text("report_date"), F.col(date_col)))
    return typed.select("*", *partition_keys("report_date"))

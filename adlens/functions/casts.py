"""Null-safe typing of text and loosely typed values (PF2-PF8, SC10).

All helpers are ``Column -> Column`` and stay inside whole-stage codegen;
with ANSI mode on, every parse of untrusted text goes through try_cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def text_or_empty(col) -> Column:
    """PF2: value as text, missing as ''."""
    return F.coalesce(_c(col).cast("string"), F.lit(""))


def long_trunc_or_zero(col) -> Column:
    """PF3 (landed responses): number or numeric text to bigint, truncating
    toward zero; missing or unreadable to 0."""
    d = _c(col).try_cast("double")
    return F.coalesce(d.try_cast("bigint"), F.lit(0).cast("bigint"))


def double_or_zero(col) -> Column:
    """PF4 / PF7 (``safe_float``): number or text to double; NULL, '', '-'
    and bad text to 0.0."""
    return F.coalesce(_c(col).try_cast("double"), F.lit(0.0))


safe_float = double_or_zero


def long_half_even(col) -> Column:
    """PF5 (bulk CSV): text to nullable bigint, rounding half to even.
    Unreadable text, '' and NaN become NULL."""
    d = _c(col).try_cast("double")
    return F.rint(d).try_cast("bigint")


def double_or_null(col) -> Column:
    """PF6 (bulk CSV): text to nullable double; NaN to NULL."""
    d = _c(col).try_cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def as_text(col) -> Column:
    """SC10: the compatibility form of a result value: text, NULL as ''."""
    return F.coalesce(_c(col).cast("string"), F.lit(""))


def all_as_text(df: DataFrame) -> DataFrame:
    """SC10 over every column of a result."""
    return df.select([as_text(c).alias(c) for c in df.columns])

"""Money sums, rounding and guarded ratios (SC1-SC4, SC14).

Sums of money are exact: values are summed as decimals, so the result does
not depend on partitioning or addition order, then rounded and returned as
double. Ratios divide values that are already exact, so every engine gives
the same double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,6)"   # per-row money (currency units, or micros)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col) -> Column:
    """A money value as an exact decimal."""
    return _c(col).cast(MONEY)


def money_sum(col) -> Column:
    """Exact sum of a money column."""
    return F.sum(money(col))


def count_sum(col) -> Column:
    """Sum of a count column as bigint."""
    return F.sum(_c(col)).cast("bigint")


def round_half_up(col, scale: int = 0) -> Column:
    """SC1: SQL ROUND (half away from zero) on an exact value, as double."""
    return F.round(_c(col), scale).cast("double")


def round_half_even(col, scale: int = 0) -> Column:
    """SC2: Python / pandas round (half to even), as double."""
    return F.bround(_c(col), scale).cast("double")


def micros_to_currency(col) -> Column:
    """SC14: micros to currency units (exact decimal)."""
    return _c(col).cast("decimal(38,0)") / F.lit(1000000)


def pct_half_up(num, den, scale: int = 2) -> Column:
    """SC1+SC3: ROUND(num * 100.0 / NULLIF(den, 0), scale) for counts, in
    integer arithmetic: half-up, exact, NULL when den is 0."""
    k = 10 ** scale
    n = _c(num).cast("decimal(38,0)")
    d = F.nullif(_c(den).cast("decimal(38,0)"), F.lit(0))
    q = F.call_function("div", n * F.lit(200 * k) + d, d * F.lit(2))
    return q.cast("double") / F.lit(float(k))


def ratio_half_up(num, den, scale: int = 4) -> Column:
    """Ratio of two counts rounded half-up to ``scale`` places; 0 when
    den is 0 (the KPI sheet convention)."""
    k = 10 ** scale
    n = _c(num).cast("decimal(38,0)")
    d = _c(den).cast("decimal(38,0)")
    q = F.call_function("div", n * F.lit(2 * k) + d, F.nullif(d, F.lit(0)) * F.lit(2))
    return F.when(d > 0, q.cast("double") / F.lit(float(k))).otherwise(F.lit(0.0))


def safe_div(num, den) -> Column:
    """SC3/SC4: num / den as double, NULL when den is 0 or NULL (shown '-')."""
    return F.try_divide(_c(num).cast("double"), F.nullif(_c(den).cast("double"), F.lit(0.0)))


def div_or_zero(num, den) -> Column:
    """SC4: num / den, 0 when den is 0 (the sheet CTR formula)."""
    d = _c(den).cast("double")
    return F.when(F.coalesce(d, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(_c(num).cast("double") / d)

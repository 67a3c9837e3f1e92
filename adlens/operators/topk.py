"""Sort / limit / top-k (TK1-TK5).

``orderBy(...).limit(n)`` is planned as TakeOrderedAndProject: every task
keeps its own n best rows and only those reach the final merge, so no full
sort or single-partition shuffle of the input happens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, by: str, tie: str | None = None, n: int | None = 10,
          descending: bool = True) -> DataFrame:
    """TK1/TK2: best ``n`` rows by ``by``; ``tie`` makes the cut deterministic
    (the reference sorts without one, Q14)."""
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    keys = [first] + ([F.col(tie).asc_nulls_last()] if tie else [])
    out = df.orderBy(*keys)
    return out.limit(n) if n is not None else out


def first_groups(df: DataFrame, pos: str, n: int = 5) -> DataFrame:
    """TK4: the first ``n`` groups in first-seen order (``pos`` = first row
    position of the group)."""
    return df.orderBy(F.col(pos).asc_nulls_last()).limit(n)


def order_by(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """TK3/TK5: sort a detail table by any column."""
    c = F.col(column)
    return df.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last())

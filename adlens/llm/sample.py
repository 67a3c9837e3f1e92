"""Bounded samples chosen by a hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import saved


def thinned(rows: DataFrame, group: str, most: int, *key: Column) -> DataFrame:
    """About ``most`` rows of each value of ``group``, chosen by the hash of ``key``."""
    counts = saved(rows.groupBy(group).agg(F.count("*").alias("_n")), "counts")
    place = F.pmod(F.xxhash64(*key, F.lit("sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return rows.join(counts, group).where(place * F.col("_n") < most).drop("_n")

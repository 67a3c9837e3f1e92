"""Window-shaped operators (WN1-WN5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_share(df: DataFrame, value: str, out: str = "share",
               within: tuple[str, ...] = ()) -> DataFrame:
    """WN1/WN2: value / SUM(value) over the frame (or within groups).

    Applied to already aggregated frames (one row per media or per shown
    week), so a window without keys moves a bounded handful of rows."""
    w = Window.partitionBy(*within)
    total = F.sum(F.col(value)).over(w)
    return df.withColumn(out, F.try_divide(F.col(value).cast("double"),
                                           F.nullif(total.cast("double"), F.lit(0.0))))


def last_per_key(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """WN3/AG11/WN5: keep the row with the highest ``seq`` per key.

    Written as a grouped ``max(struct(seq, ...))`` rather than a
    row_number window: the aggregate combines map-side, so a key that holds
    a large share of the rows is reduced before the shuffle instead of
    being sorted in one task. Ties on ``seq`` resolve on the remaining
    columns, so the choice is deterministic."""
    rest = [c for c in df.columns if c not in keys and c != seq]
    packed = F.max(F.struct(F.col(seq).alias(seq), *[F.col(c) for c in rest])).alias("_last")
    return (df.groupBy(*keys).agg(packed)
              .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in [seq] + rest]))


def position_within(df: DataFrame, keys: list[str], order: list, bucket, out: str = "position") -> DataFrame:
    """Row position (1, 2, ...) within each key in the given order, without
    putting a whole key into one task.

    ``bucket`` is a column that never falls while ``order`` goes on (a range
    of its first column, such as ``seq div 1000`` or a day). Rows are numbered
    within (key, bucket) and shifted by the number of the key's rows in
    earlier buckets: a running sum over one pre-aggregated row per (key,
    bucket). Both depend on the rows' values alone, not on where they lie, so
    a recomputation after a lost executor numbers them the same way. NULL
    keys are a key of their own. Choose buckets so that one holds what a task
    can sort."""
    ordered = [o if not isinstance(o, str) else F.col(o) for o in order]
    rows = df.withColumn("_bucket", bucket if not isinstance(bucket, str) else F.col(bucket))
    sizes = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_b"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    same = F.col("_bucket").eqNullSafe(F.col("_b"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    within = Window.partitionBy(*keys, "_bucket").orderBy(*ordered)
    numbered = rows.withColumn("_row", F.row_number().over(within))
    return (numbered.join(starts, same, "left").withColumn(out, F.col("_start") + F.col("_row"))
                    .select(*[c for c in df.columns if c != out], out))

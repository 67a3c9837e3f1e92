"""Joins and lookups (JN1-JN4).

No join here forces a broadcast. Spark broadcasts a side only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
re-checks with the real shuffle size at run time; above that the join stays
a sort-merge join, and AQE splits skewed partitions of the fact side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import last_per_key

MASTER_DROP = ("adv_id", "basic_date", "agroup_id")


def latest_master(master: DataFrame, seq: str = "seq", key: str = "kwd_id") -> DataFrame:
    """AG11/WN3: one master row per keyword, the one with the highest
    sequence (the reference keeps the last row in file order, Q8); the key
    is trimmed (PF11). NULL keys cannot match and are dropped."""
    m = master.withColumn(key, F.trim(F.col(key))).filter(F.col(key).isNotNull())
    return last_per_key(m, [key], seq)


def file_order(df: DataFrame) -> Column:
    """Place of a row in its files: path, start of the file's split, place in
    the split. Apply to the frame that reads the files, before any shuffle;
    a split is read in order by one task, so the place grows with the row."""
    meta = df["_metadata"]
    return F.struct(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def enrich_with_master(fact: DataFrame, master: DataFrame, key: str = "kwd_id",
                       seq: str | None = None) -> DataFrame:
    """JN1: left join of keyword facts to the de-duplicated master, without
    the master's ``adv_id``, ``basic_date``, ``agroup_id``. NULL keys do not
    match (deviation Q7).

    With ``seq`` the master is de-duplicated here; without it the caller says
    that ``master`` holds one row per key already (``latest_master``, best
    written to a table first: a join between tables lets AQE split the fact
    partition of a keyword that holds a large share of the rows)."""
    m = master.drop(*MASTER_DROP)
    m = latest_master(m, seq, key).drop(seq) if seq is not None else m.withColumn(key, F.trim(F.col(key)))
    f = fact.withColumn(key, F.trim(F.col(key)))
    return f.join(m, on=key, how="left")


def by_date_and_media(unified: DataFrame, measures: list[str],
                      media_values=("google", "kakao")) -> DataFrame:
    """JN4: google and kakao side by side per date (a pivot on a fixed value
    list written as conditional sums): one partial+final aggregate keyed by
    date, no join; a missing side is 0."""
    aggs = [F.coalesce(F.sum(F.when(F.col("media") == v, F.col(m))), F.lit(0)).alias(f"{v}_{m}")
            for v in media_values for m in measures]
    return unified.groupBy("report_date").agg(*aggs)


def daily_lookup(daily: DataFrame, table: DataFrame, key="report_date",
                 seq: str | None = None, fill: dict | None = None) -> DataFrame:
    """JN2: each daily row with the table row of the same date (the last one
    by ``seq`` when dates repeat); unmatched measures become 0."""
    keys = [key] if isinstance(key, str) else list(key)
    t = last_per_key(table, keys, seq).drop(seq) if seq else table
    out = daily.join(t, on=keys, how="left")
    return out.fillna(fill or {c: 0 for c in t.columns if c not in keys})


def media_value(pie: DataFrame, media: str, name_col: str = "media",
                value: str = "cost", pos: str = "pos") -> DataFrame:
    """JN3: the value on the first row of the given media, else 0."""
    first = (pie.filter(F.col(name_col) == media)
                .agg(F.min_by(F.col(value), F.col(pos)).alias(value)))
    return first.select(F.coalesce(F.col(value), F.lit(0.0)).alias(value))

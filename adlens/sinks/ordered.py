"""Lookup tables stored by key and order (LK1, LK2, LK6).

Rows are bucketed by the lookup key and sorted within a bucket, so a lookup of
one key reads one bucket and needs no exchange. The write rebalances rows on
the bucket; a bucket that a hot key fills is split over several tasks and
files instead of going to one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUCKETS = 64


def store_ordered(df: DataFrame, table: str, path: str, key: str, order: list[str], buckets: int = BUCKETS) -> None:
    """``df`` as the external table ``table`` at ``path``, bucketed by ``key`` and sorted by ``order``."""
    bucket = "_bucket"
    while bucket in df.columns:
        bucket += "_"
    rows = df.withColumn(bucket, F.pmod(F.hash(key), F.lit(buckets))).hint("rebalance", bucket).drop(bucket)
    (rows.write.mode("overwrite").format("parquet").option("path", path)
         .bucketBy(buckets, key).sortBy(*order).saveAsTable(table))


def lookup(spark: SparkSession, table: str, key: str, value, order: list[Column], where: Column | None = None) -> DataFrame:
    """The rows of one key in ``order``, with their ``position`` from 1; one bucket is read, nothing is exchanged."""
    rows = spark.table(table).where(F.col(key) == F.lit(value))
    if where is not None:
        rows = rows.where(where)
    return rows.withColumn("position", F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def conversations_of(spark: SparkSession, table: str, user: str) -> DataFrame:
    """LK1: a user's conversations, newest first."""
    return lookup(spark, table, "user_id", user, [F.col("last_seq").desc(), F.col("conversation_id").asc()])


def messages_of(spark: SparkSession, table: str, conversation: str) -> DataFrame:
    """LK2: the messages of a conversation in time order."""
    return lookup(spark, table, "conversation_id", conversation, [F.col("seq").asc(), F.col("message_id").asc()])


def active_reports_of(spark: SparkSession, table: str, user: str, as_of) -> DataFrame:
    """LK6: a user's unexpired reports, by expiry."""
    return lookup(spark, table, "user_id", user, [F.col("expires_at").asc(), F.col("report_id").asc()],
                  F.col("expires_at") > F.lit(str(as_of)).cast("timestamp_ntz"))

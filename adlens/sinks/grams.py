"""Substring search by stored trigrams (PF17, LK3).

Rows are stored in blocks of neighbouring texts; a posting table says which
blocks hold a trigram of the lower-cased text. A search looks up the trigrams
of its own text, reads only the blocks that hold all of them, and tests each
row there with ``contains``, so its rows are those of ``filters.search``.

Defined results: a null text is never found; an empty search text finds every
row with a text; search texts of under three characters have no trigram and
read all blocks; an empty table gives an empty result; repeated rows are all
returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import search

SIZE = 3
#: Blocks of a table, the most numbers that a search gathers on the driver. Choose it for blocks of some 128 MB.
BLOCKS = 256


def grams(text: Column) -> Column:
    """The distinct trigrams of a lower-cased text; none for shorter ones."""
    low = F.lower(text)
    starts = F.when(F.length(low) >= SIZE, F.sequence(F.lit(1), F.length(low) - (SIZE - 1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(low, i, F.lit(SIZE))))


def store_searchable(df: DataFrame, path: str, column: str, blocks: int = BLOCKS) -> None:
    """``df`` under ``path/rows`` in blocks by ``column``, and its postings under ``path/postings``.

    Rows are dealt by ranges of the text, so equal and similar texts share
    blocks and a trigram has few of them. A text in a large part of the rows
    is dealt on by a hash of the whole row and takes several blocks.
    """
    spark = df.sparkSession
    block = "_block"
    if block in df.columns:
        raise ValueError(f"the column {block} is taken")
    salt = F.xxhash64(*[F.col(c) for c in df.columns])
    rows = df.repartitionByRange(blocks, F.lower(F.col(column)), salt).withColumn(block, F.spark_partition_id())
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(block).parquet(f"{path}/rows")
    spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{path}/schema")
    stored = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    posted = stored.select(F.explode(grams(F.col(column))).alias("gram"), block).distinct()
    # by ranges of trigrams: their least and greatest ones in a file's footer say whether it is read at all
    (posted.repartitionByRange("gram").sortWithinPartitions("gram", block)
     .write.mode("overwrite").parquet(f"{path}/postings"))


def blocks_with(spark: SparkSession, path: str, text: str) -> list[int] | None:
    """Numbers of the blocks that hold all trigrams of ``text``; None where it has none."""
    own = spark.range(1).select(grams(F.lit(text)).alias("g")).first()["g"]
    if not own:
        return None
    posted = spark.read.schema("gram string, _block int").parquet(f"{path}/postings").where(F.col("gram").isin(own))
    held = posted.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(own))
    return sorted(r["_block"] for r in held.select("_block").collect())  # at most as many as there are blocks


def find(spark: SparkSession, path: str, column: str, text: str) -> DataFrame:
    """The stored rows whose ``column`` contains ``text`` in any case."""
    schema = spark.read.parquet(f"{path}/schema").schema.add("_block", "integer")
    rows = spark.read.schema(schema).parquet(f"{path}/rows")
    blocks = blocks_with(spark, path, text)
    if blocks is not None:
        rows = rows.where(F.col("_block").isin(blocks)) if blocks else rows.where(F.lit(False))
    return search(rows, column, text).drop("_block")

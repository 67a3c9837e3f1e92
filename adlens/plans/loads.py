"""Load jobs: bulk CSV extracts and landed responses to the fact tables
(the reference's bulk upload script and daily batch, as Spark jobs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import compact_date_text, partition_keys
from ..operators.aggregates import observed
from ..operators.filters import split_valid
from ..operators.ingest import type_batch, type_bulk
from ..operators.joins import enrich_with_master, latest_master
from ..schemas import PARTITION_COLUMNS
from ..session import scratch_path
from ..sinks.tables import write_partitions
from ..sources.readers import (explode_accounts, flatten_google, flatten_kakao, read_csv_text,
                               read_responses)

PLACE = "_place"


def read_master(spark: SparkSession, path: str, seq: str | None = None, sep: str | None = None, **csv) -> DataFrame:
    """Keyword master CSV with one row per keyword, as a written table: the
    row with the highest ``seq`` (a number) where that column is named, else
    the last one in file order (files by path, rows by place)."""
    master = read_csv_text(spark, path, sep, place=PLACE, **csv)
    if seq is not None:
        master = master.withColumn(seq, F.col(seq).try_cast("bigint"))
    one = latest_master(master, seq or PLACE)
    out = scratch_path(spark, "latest_master")
    one.drop(PLACE, *([seq] if seq else [])).write.parquet(out)
    return spark.read.parquet(out)


def bulk_load(spark: SparkSession, platform: str, keyword_path: str, table: str,
              quarantine: str | None = None, master_path: str | None = None,
              master_seq: str | None = None, sep: str | None = None, **csv) -> dict:
    """CSV extract (all text) -> typed rows (-> master enrichment for kakao)
    -> rows with a date to the table (dynamic overwrite of their days), rows
    without one to ``quarantine`` (Q6), which a rerun replaces.

    The typed rows are written once to the shared folder; both outputs are
    read from there. Row counts per stage (AG15: read, enriched, written,
    quarantined) are observed metrics of that one write;
    ``result["counts"]()`` returns them after the call."""
    read, first = observed(read_csv_text(spark, keyword_path, sep, **csv), "read")
    facts = type_bulk(read, platform)
    if master_path is not None:
        facts = enrich_with_master(facts, read_master(spark, master_path, master_seq, sep, **csv))
    last = Observation("typed")
    facts = facts.observe(last, F.count(F.lit(1)).alias("rows"), F.count("report_date").alias("dated"))
    typed = scratch_path(spark, "typed_rows")
    facts.write.parquet(typed)
    good, bad = split_valid(spark.read.schema(facts.schema).parquet(typed))
    write_partitions(good, table)
    if quarantine is not None:
        bad.write.mode("overwrite").parquet(quarantine)

    def counts() -> dict:
        n = last.get
        enriched = {"enriched": n["rows"]} if master_path is not None else {}
        return {"read": first.get["rows"], **enriched, "written": n["dated"], "quarantined": n["rows"] - n["dated"]}

    return {"good": good, "quarantine": bad, "counts": counts}


def typed_responses(docs: DataFrame, platform: str, date: str | None = None, customer_id: str | None = None,
                    accounts: DataFrame | None = None, master: DataFrame | None = None,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Landed responses -> flattened, typed rows; kakao rows get the columns of
    ``master`` (one row per keyword), as the bulk path does (Q5)."""
    if platform == "google":
        return type_batch(flatten_google(docs, customer_id, date, keep), platform, passthrough=keep)
    typed = type_batch(flatten_kakao(docs, date, accounts, keep), platform, passthrough=keep)
    return typed if master is None else enrich_with_master(typed, master)


def batch_load(spark: SparkSession, platform: str, docs_path: str, table: str, date: str | None = None,
               customer_id: str | None = None, accounts_path: str | None = None,
               master: DataFrame | None = None, quarantine: str | None = None) -> DataFrame:
    """Landed responses of one day -> typed (and, for kakao, enriched) rows ->
    the table (the day's partition replaced; an empty extract changes
    nothing); rows without a date go to ``quarantine``, which a rerun replaces.

    The typed rows are written once to the shared folder, without the partition
    columns, and both outputs are read from there. What the date of a row tells
    (partition columns, ``basic_date``) is not shuffled but made again."""
    docs = read_responses(spark, docs_path, platform)
    acc = explode_accounts(read_responses(spark, accounts_path, "accounts")) if accounts_path else None
    typed = typed_responses(docs, platform, date, customer_id, acc, master)
    rows = scratch_path(spark, "typed_rows")
    plain = typed.drop(*PARTITION_COLUMNS)
    plain.write.option("compression", "zstd").parquet(rows)
    keys = dict(zip(PARTITION_COLUMNS, partition_keys("report_date")))
    good, bad = split_valid(spark.read.schema(plain.schema).parquet(rows).withColumns(keys).select(*typed.columns))
    write_partitions(good, table, by="report_date", remade={"basic_date": compact_date_text("report_date"), **keys})
    if quarantine is not None:
        bad.write.mode("overwrite").parquet(quarantine)
    return good

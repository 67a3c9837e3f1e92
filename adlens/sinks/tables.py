"""Partitioned Parquet writes and catalog tables (SNK1-SNK6)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession

from ..schemas import PARTITION_COLUMNS, TABLES
from ..session import FREEING, isolated, path_exists


def write_partitions(df: DataFrame, path: str, keys=tuple(PARTITION_COLUMNS),
                     max_records_per_file: int = 5_000_000, fmt: str = "parquet",
                     dynamic: bool = True, by: str | None = None, remade: dict[str, Column] | None = None) -> None:
    """SNK1 + SNK6: Snappy Parquet under ``year=/month_p=/day=``, replacing
    only the partitions present in ``df`` (dynamic overwrite). A rerun of a
    day replaces that day (Q10); an empty frame changes nothing (Q9), so no
    count is needed to guard it.

    The rows are rebalanced on the partition keys: AQE packs small days into
    one file and splits a day holding a large share of the rows across
    several tasks; ``maxRecordsPerFile`` bounds file size. The write runs in a
    session of its own with coalescing off: each day lies whole in one of the
    tasks anyway, and merging them would only put file writes in a row. The
    shuffle files go when the write ends.

    With ``by`` the rows are dealt out by that column, one value of which has
    one value of each key; ``remade`` columns (made of others of ``df``, keys
    or not) are left out of the shuffle and made after it."""
    spark = df.sparkSession
    own = isolated(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false", **FREEING})
    remade = remade or {}
    order = df.columns + [c for c in remade if c not in df.columns]
    view = f"adlens_write_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    try:
        dealt = own.table(f"global_temp.{view}").drop(*remade).hint("rebalance", *([by] if by else keys))
        w = (dealt.select(*[remade[c].alias(c) if c in remade else c for c in order]).write
             .mode("overwrite" if dynamic else "errorifexists")
             .option("partitionOverwriteMode", "dynamic")
             .option("maxRecordsPerFile", max_records_per_file)
             .partitionBy(*keys))
        if fmt == "parquet":
            w = w.option("compression", "snappy")
        w.format(fmt).save(path)
    finally:
        spark.catalog.dropGlobalTempView(view)


def create_tables(spark: SparkSession, root: str, database: str = "ad_report",
                  drop_first: bool = False, platforms=("google", "kakao"),
                  obsolete: tuple[str, ...] = ()) -> list[str]:
    """SNK3: external tables with the fixed schema over ``root/{platform}``;
    tables named in ``obsolete`` are dropped."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/_database'")
    for name in obsolete:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    names = []
    for p in platforms:
        name = f"{database}.{p}_ad_performance"
        if drop_first:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        schema = TABLES[f"{p}_ad_performance"]
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
                  f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{root}/{p}'")
        names.append(name)
    return names


def register_partitions(spark: SparkSession, table: str, days: DataFrame | None = None) -> None:
    """SNK2: register partition folders written outside the catalog;
    existing ones are kept. ``days`` (year, month_p, day of the rows just
    written: one row a day) names the folders to add; without it all folders
    of the table are listed."""
    if days is None:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        return
    parts = [f"PARTITION (year='{r[0]}', month_p='{r[1]}', day='{r[2]}')"
             for r in days.select(*PARTITION_COLUMNS).distinct().collect()]
    for i in range(0, len(parts), 500):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(parts[i:i + 500]))


def append_report(df: DataFrame, path: str) -> None:
    """SNK4: append the report rows whose ``report_id`` is not saved yet, so a
    rerun of a report job adds nothing."""
    spark = df.sparkSession
    if path_exists(spark, f"{path}/_SUCCESS"):
        df = df.join(spark.read.parquet(path).select("report_id"), "report_id", "left_anti").select(*df.columns)
    df.write.mode("append").parquet(path)


def write_sheets(tables: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """SNK5: one folder per report table (workbook rendering is not built)."""
    for name, t in tables.items():
        t.write.mode("overwrite").format(fmt).option("header", True).save(f"{path}/{name}")

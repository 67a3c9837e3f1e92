"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from adlens.session import isolated, scratch_path

#: Arrow batches of a Python step over whole texts, where memory is tight.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def saved(df: DataFrame, name: str, settings: dict[str, str] | None = None, read: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage (a lost executor costs no recomputation of what is
    already written) and gives later joins plain scans, whose shuffles Spark
    can split when a key is hot. With ``settings`` the write runs in a session
    of its own that has them, with ``read`` the result is read in such a one;
    the caller's session stays as it is.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if not settings:
        df.write.parquet(path)
    else:
        view = f"adlens_saved_{uuid.uuid4().hex}"
        df.createGlobalTempView(view)
        try:
            isolated(spark, settings).table(f"global_temp.{view}").write.parquet(path)
        finally:
            spark.catalog.dropGlobalTempView(view)
    return (isolated(spark, read) if read else spark).read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name

"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on. ANSI stays on (Spark 4 default), so the
# library uses try_cast / try_divide / nullif where input may be dirty.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "adlens", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches. On a cluster, pass the cluster
    master and size ``shuffle_partitions`` to the data (AQE coalesces)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "16g",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """This package as an archive for the Python workers, once an application:
    machines of a cluster need not have it installed. Sessions that were not
    made by ``build_session`` call it before operators with Python steps."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    # a file of the driver's own, which Spark copies to every machine
    archive = os.path.join(tempfile.mkdtemp(prefix="adlens-"), "adlens.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(here):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(here)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read.
    Only when it is unset (local tests) a folder under /tmp is chosen.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = os.path.join("/tmp", "adlens-checkpoints")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location.

    Used for tables that a job writes and then reads back (round trips,
    stream sinks, stream checkpoints). Never a machine-local folder on a
    cluster: it derives from ``spark.checkpoint.dir``.
    """
    base = ensure_checkpoint_dir(spark)
    return f"{base}/adlens-scratch/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def existing(spark: SparkSession, pattern: str) -> list[str]:
    """Folders or files that match a glob pattern (only those are listed)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return [f.getPath().toString() for f in found] if found is not None else []


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the job's own."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def isolated(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """Another session of the same application with its own SQL settings, for
    a step that needs one set; the caller's session stays as it is."""
    own = spark.newSession()
    fresh = own.conf.getAll
    same = {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.") and fresh.get(k) != v}
    for k, v in {**same, **settings}.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


#: Shuffle files go when the write that made them ends; by default they stay until the driver happens to collect its garbage.
FREEING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

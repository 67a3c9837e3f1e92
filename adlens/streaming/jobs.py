"""Streaming ingest and dead-letter metrics (SRC8, ST1-ST5).

Sinks are written with ``foreachBatch`` into folders keyed by the batch id
(overwrite mode), so a micro-batch replayed after a failure rewrites the
same files instead of adding rows: with the checkpoint this gives
exactly-once output on top of Spark's at-least-once batch replay.
Checkpoints and sinks live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.json_fields import message_platform, platform_of
from ..operators.filters import split_valid
from ..plans.loads import typed_responses
from ..schemas import GOOGLE_RESPONSE, KAKAO_RESPONSE, QUEUE_MESSAGE
from ..session import scratch_path
from ..sinks.tables import write_partitions


def queue_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """SRC8: queue / dead-letter messages landed as JSON files."""
    r = spark.readStream.schema(QUEUE_MESSAGE)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


def message_fields(messages: DataFrame, keep: tuple = ()) -> DataFrame:
    """SC11/SC12/ST5 on a message stream: the platform the message names
    (or 'unknown'), whether it is a served one, the sent instant from the
    epoch-ms text, and the receive count (or 'unknown')."""
    ms = F.col("attributes.SentTimestamp").try_cast("bigint")
    return messages.select(
        "message_id", "body",
        message_platform(F.col("body")).alias("platform"),
        (platform_of(F.col("body")) != "unknown").alias("served"),
        F.timestamp_millis(ms).alias("sent"),
        F.coalesce(F.col("attributes.ApproximateReceiveCount"), F.lit("unknown")).alias("receive_count"), *keep)


#: The queue keeps a failed message for 14 days after its first 4: a late one is at most this old.
RETENTION = "18 days"


def dead_letter_counts(messages: DataFrame, window: str = "5 minutes", delay: str = RETENTION,
                       dedupe: bool = True) -> DataFrame:
    """ST2 + ST4: failed messages per platform per event-time window. The
    sent time is that of the first send, so the watermark's delay covers the
    queues' retention: no message that a queue can still deliver is late. It
    bounds the state, which belongs on disk (``STATE_STORE``); a message
    delivered again (same ``message_id``) within it is counted once. Messages
    without a sent time cannot be windowed: see ``untimed_counts``."""
    m = message_fields(messages).filter(F.col("sent").isNotNull()).withWatermark("sent", delay)
    if dedupe:
        m = m.dropDuplicatesWithinWatermark(["message_id"])
    g = m.groupBy(F.window("sent", window).alias("w"), "platform").agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.unix_millis(F.col("w.start")).alias("window_start_ms"),
                    F.unix_millis(F.col("w.end")).alias("window_end_ms"), "platform", "n")


def untimed_counts(messages: DataFrame) -> DataFrame:
    """ST2 + ST4: messages without a sent time, per platform, each
    ``message_id`` once (state: the ids of such messages; without an event
    time none can be let go)."""
    m = message_fields(messages).filter(F.col("sent").isNull()).dropDuplicates(["message_id"])
    return m.groupBy("platform").agg(F.count(F.lit(1)).alias("n"))


#: Session settings for streams with large state: keep it on the executors' disks, its buffers within a fixed size.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
               "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500"}


def _batch_sink(path: str, fmt: str = "parquet"):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
    return write


def run_update_stream(stream: DataFrame, sink: str, checkpoint: str, available_now: bool = True):
    """Run an aggregate in update mode into a batch-keyed sink."""
    q = (stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
               .foreachBatch(_batch_sink(sink)))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


def read_latest(spark: SparkSession, sink: str, keys: list[str]) -> DataFrame:
    """Current result of an update-mode sink: for every key the row written
    by the latest batch (later batches carry updated counts)."""
    return _latest(spark.read.parquet(sink), keys)


def _latest(d: DataFrame, keys: list[str]) -> DataFrame:
    value_cols = [c for c in d.columns if c not in keys and c != "batch_id"]
    last = F.max(F.struct(F.col("batch_id"), *[F.col(c) for c in value_cols])).alias("_l")
    return d.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_l.{c}").alias(c) for c in value_cols])


def compact_sink(spark: SparkSession, sink: str, keys: list[str], out: str) -> None:
    """Bound an update-mode sink: its latest rows as one batch (number -1) in
    a new folder ``out``, which a stream restarted with the same checkpoint
    then writes to; the old folder can expire."""
    read_latest(spark, sink, keys).write.mode("overwrite").parquet(f"{out}/batch_id=-1")


def route_stream(messages: DataFrame, routed: str, checkpoint: str, available_now: bool = True):
    """ST3: messages for a served platform to ``routed`` under
    ``route=good``; unparseable bodies and unknown platforms under
    ``route=quarantine``. One write per batch, under its batch id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        f = message_fields(batch).withColumn("route", F.when(F.col("served"), "good").otherwise("quarantine"))
        f.write.mode("overwrite").partitionBy("route").parquet(f"{routed}/batch_id={batch_id}")
    q = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


RUN_MANIFEST = "run bigint, path string"


def finish_run(spark: SparkSession, manifests: str, run: int, path: str) -> None:
    """Say that landing run ``run`` is complete: one manifest file, written
    when all files of the run lie under ``path``."""
    (spark.createDataFrame([(run, path)], RUN_MANIFEST).coalesce(1)
          .write.mode("overwrite").json(f"{manifests}/run={run}"))


def run_stream(spark: SparkSession, manifests: str, max_files: int | None = None) -> DataFrame:
    """Manifests of complete landing runs."""
    r = spark.readStream.schema(RUN_MANIFEST)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(f"{manifests}/run=*/").select("run", "path")


def ingest_run(spark: SparkSession, platform: str, run: int, path: str, table: str, days: str, quarantine: str,
               customer_id: str | None = None, master: DataFrame | None = None, counts: str | None = None,
               batch_id: int = 0) -> None:
    """ST1 body: one complete landing run to the fact table.

    A run holds complete extracts of the days in it. Of a day, the newest run
    (highest run number) stays: ``days`` is a small table with one row per
    (day, run) ingested, and days that a newer run has already filled are left
    alone, so runs may arrive in any order and a replayed run changes nothing.
    Rows without a date go to ``quarantine/run=<run>``.

    AG15: the rows read, quarantined, written and superseded (of days that a
    newer run has filled) are observed metrics of these writes; with
    ``counts`` they are kept there, one row a run, which a replay rewrites."""
    docs = spark.read.schema(GOOGLE_RESPONSE if platform == "google" else KAKAO_RESPONSE).json(path)
    typed = typed_responses(docs, platform, customer_id=customer_id, master=master)
    read, kept = Observation("run_read"), Observation("run_kept")
    typed = typed.observe(read, F.count(F.lit(1)).alias("rows"), F.count("report_date").alias("dated"))
    rows = scratch_path(spark, "run_rows")
    typed.write.parquet(rows)
    good, bad = split_valid(spark.read.schema(typed.schema).parquet(rows))
    bad.write.mode("overwrite").parquet(f"{quarantine}/run={run}")
    spark.createDataFrame([], RUN_DAYS).write.mode("append").parquet(days)
    newer = spark.read.schema(RUN_DAYS).parquet(days).filter(F.col("run") > run).select("report_date").distinct()
    own = good.join(newer, "report_date", "left_anti").select(*good.columns)
    write_partitions(own, table)
    filled = own.groupBy("report_date").agg(F.count(F.lit(1)).alias("n")).observe(kept, F.sum("n").alias("rows"))
    filled.select("report_date", F.lit(run).cast("bigint").alias("run")).write.mode("append").parquet(days)
    if counts is not None:
        n, written = read.get, kept.get["rows"] or 0
        row = (batch_id, n["rows"], written, n["dated"] - written, n["rows"] - n["dated"])
        spark.createDataFrame([row], RUN_COUNTS).coalesce(1).write.mode("overwrite").parquet(f"{counts}/run={run}")


RUN_DAYS = "report_date date, run bigint"
RUN_COUNTS = "batch_id bigint, read bigint, written bigint, superseded bigint, quarantined bigint"


def read_run_counts(spark: SparkSession, state: str) -> DataFrame:
    """AG15 of an ingest stream: row counts by run, with the micro-batch that ingested it last."""
    return spark.read.schema(RUN_COUNTS + ", run bigint").parquet(f"{state}/counts")


def ingest_stream(spark: SparkSession, manifests: str, platform: str, table: str, state: str, quarantine: str,
                  customer_id: str | None = None, master: DataFrame | None = None, available_now: bool = True,
                  max_files: int | None = None):
    """ST1: complete landing runs to the partitioned fact table. ``state``
    holds the stream's checkpoint, the table of ingested days and the row
    counts of each run (``read_run_counts``). Each
    micro-batch names a few runs (one manifest row each), which are ingested
    in the order of their numbers."""
    def write(batch: DataFrame, batch_id: int) -> None:
        for r in sorted(batch.collect()):
            ingest_run(spark, platform, r["run"], r["path"], table, f"{state}/days", quarantine, customer_id, master,
                       f"{state}/counts", batch_id)
    q = (run_stream(spark, manifests, max_files).writeStream.option("checkpointLocation", f"{state}/checkpoint")
         .foreachBatch(write))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 hour")
    return q.start()

"""Queue deliveries as streams that lose no message (ST2, ST4).

``count_stream`` counts failed messages by platform and window of their sent
time. A message is known by its id, which is kept for the queues' retention
after its arrival: the state ends by the time of arrival, which only grows, so
no message is too late for it, whatever its sent time, and messages without a
sent time are let go as well. Each micro-batch writes what it adds; the sum
over the batches is the count. Messages received later than the retention
after they were sent go to an output of their own.

``retry_stream`` is the queue's rule: a message that fails ``most`` times goes
to the dead letters, once; one that succeeds goes on, once. The messages known
are a table, written anew by each micro-batch; one of which nothing is heard
for the retention leaves it as ``expired``.

All outputs are folders by batch number, so a replayed batch rewrites its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.json_fields import message_platform
from ..schemas import DELIVERY
from ..session import existing, path_exists, remove
from .jobs import RETENTION, message_fields

MAX_RECEIVES = 3
_DAYS = int(RETENTION.split()[0])


def _start(stream: DataFrame, checkpoint: str, write, available_now: bool):
    q = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


def once_by_arrival(messages: DataFrame, retention: str = RETENTION) -> DataFrame:
    """Each ``message_id`` once (without one: each body and sent time); its state ends ``retention`` after the
    micro-batch that brought it."""
    bare = F.sha2(F.concat_ws("\n", F.lit("no id"), "body", F.col("sent").cast("string")), 256)
    return (messages.withColumn("arrived", F.current_timestamp()).withColumn("known_by", F.coalesce("message_id", bare))
            .withWatermark("arrived", retention).dropDuplicatesWithinWatermark(["known_by"]))


def count_stream(messages: DataFrame, sink: str, checkpoint: str, window: str = "5 minutes", retention: str = RETENTION,
                 available_now: bool = True):
    """ST2 + ST4: what each micro-batch adds to the counts, under ``sink/counts`` (``window_start_ms`` NULL: no sent
    time), from its messages under ``sink/received`` (with their bodies where they are late). The time of receipt is the queue's, or else that of arrival."""
    received = F.coalesce(F.timestamp_millis(F.col("attributes.ApproximateFirstReceiveTimestamp").try_cast("bigint")),
                          F.col("arrived"))
    fields = message_fields(messages, keep=("attributes",))
    rows = once_by_arrival(fields, retention).withColumn("received", received)
    spark = messages.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        told = batch.withColumn("late", F.coalesce(F.col("received") > F.col("sent") + F.expr(f"INTERVAL {retention}"), F.lit(False)))
        at = f"{sink}/received/batch_id={batch_id}"
        told.select("message_id", F.when(F.col("late"), F.col("body")).alias("body"), "platform", "sent", "received",
                    "receive_count", "late").write.mode("overwrite").parquet(at)
        told = spark.read.schema(RECEIPTS).parquet(at)    # the stateful plan runs once
        own = told.where(~F.col("late"))
        timed = own.groupBy(F.window("sent", window).alias("w"), "platform").agg(F.count(F.lit(1)).alias("n")).select(
            F.unix_millis("w.start").alias("window_start_ms"), F.unix_millis("w.end").alias("window_end_ms"), "platform", "n")
        bare = own.where("sent IS NULL").groupBy("platform").agg(F.count(F.lit(1)).alias("n"))
        (timed.unionByName(bare, allowMissingColumns=True)
         .write.mode("overwrite").parquet(f"{sink}/counts/batch_id={batch_id}"))

    return _start(rows, checkpoint, write, available_now)


RECEIPTS = ("message_id string, body string, platform string, sent timestamp, received timestamp, receive_count string, "
            "late boolean")
COUNTS = "window_start_ms bigint, window_end_ms bigint, platform string, n bigint, batch_id bigint"


def read_counts(spark: SparkSession, sink: str) -> DataFrame:
    """The counts so far: the sums of what the batches added."""
    return (spark.read.schema(COUNTS).parquet(f"{sink}/counts")
            .groupBy("window_start_ms", "window_end_ms", "platform").agg(F.sum("n").alias("n")))


def read_late(spark: SparkSession, sink: str) -> DataFrame:
    """The messages received later than the retention after they were sent."""
    return spark.read.schema(RECEIPTS).parquet(f"{sink}/received").where("late").drop("late", "batch_id")


def compact_counts(spark: SparkSession, sink: str, out: str) -> None:
    """The sums as one batch (number -1) in a new folder, for a stream restarted with the same checkpoint."""
    read_counts(spark, sink).write.mode("overwrite").parquet(f"{out}/counts/batch_id=-1")


# ---- retries ----------------------------------------------------------------


def delivery_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Deliveries landed as JSON files: message_id, body, receipt (one per delivery), received_ms, ok."""
    r = spark.readStream.schema(DELIVERY)
    return (r.option("maxFilesPerTrigger", max_files) if max_files else r).json(path)


#: A message known to the queue: its receipts so far (``most`` at most) and last body (both NULL once it has left), when
#: it is let go, and how it left in the micro-batch of its version (``route`` NULL: it did not).
MESSAGES = ("message_id string, receipts array<string>, body string, done boolean, ends_ms bigint, route string, "
            "receives int")


def distinct_deliveries(deliveries: DataFrame, slack: str = "1 hour") -> DataFrame:
    """Deliveries with their time of arrival, equal ones that arrive within the same ``slack`` once. Those without a
    message id or receipt are not messages of the queue and are left out."""
    rows = deliveries.where(F.col("message_id").isNotNull() & F.col("receipt").isNotNull()).select(
        "message_id", "body", "receipt", F.coalesce("received_ms", F.lit(0)).alias("received_ms"),
        F.coalesce("ok", F.lit(False)).alias("ok"), F.current_timestamp().alias("arrived"))
    micros = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {slack}"))
    told = rows.withColumn("cell", F.floor(F.unix_micros("arrived") / F.greatest(micros, F.lit(1)))).withColumn(
        "said", F.sha2(F.to_json(F.struct("received_ms", "ok", "body")), 256))
    return (told.withWatermark("arrived", slack).dropDuplicatesWithinWatermark(["message_id", "receipt", "said", "cell"])
            .withColumn("arrived_ms", F.unix_millis("arrived")).drop("said", "cell"))


def _heard(rows: DataFrame, most: int) -> DataFrame:
    """(message_id, arrived_ms, heard): the first deliveries of each message of one micro-batch in the order of their
    receipt, each receipt once. Of ``2 * most - 1`` at least ``most`` are new to a message that has not left."""
    once = rows.repartition("message_id").groupBy("message_id", "receipt").agg(
        F.min(F.struct("received_ms", "ok", "body")).alias("d"), F.max("arrived_ms").alias("arrived_ms"))
    first = Window.partitionBy("message_id").orderBy("d.received_ms", "receipt")
    some = once.withColumn("n", F.row_number().over(first)).where(F.col("n") < 2 * most)
    return some.groupBy("message_id").agg(F.max("arrived_ms").alias("arrived_ms"), F.array_sort(F.collect_list(
        F.struct("n", "receipt", "d.ok", "d.body"))).alias("heard"))


def retried(rows: DataFrame, known: DataFrame, most: int, keep_ms: int) -> DataFrame:
    """ST4 for one micro-batch: the messages ``known`` before (``MESSAGES``) after its deliveries (``distinct_deliveries``).

    A message leaves with its first success (route ``good``) or when it has failed ``most`` times (``dead-letter``). A
    receipt counts once, however often it is delivered."""
    both = known.drop("route", "receives").join(_heard(rows, most), "message_id", "full_outer")
    nothing = F.array().cast("array<string>")
    both = both.withColumn("done", F.coalesce("done", F.lit(False))).withColumn("receipts", F.coalesce("receipts", nothing))
    new = F.filter("heard", lambda x: ~F.array_contains(F.col("receipts"), x["receipt"]))
    both = both.withColumn("new", F.when(F.col("heard").isNotNull() & ~F.col("done"), new))
    success = F.nullif(F.array_position(F.transform("new", lambda x: x["ok"]), F.lit(True)), F.lit(0))
    both = both.withColumn("at", F.least(success, F.lit(most) - F.size("receipts")).cast("int"))
    both = both.withColumn("at", F.when(F.col("at") <= F.size("new"), F.col("at")))
    left, last = F.col("at").isNotNull(), F.get("new", F.size("new") - 1)
    leaving = F.get("new", F.col("at") - 1)
    ends = F.greatest("ends_ms", F.col("arrived_ms") + F.lit(keep_ms))
    return both.select(
        "message_id", F.when(~left & ~F.col("done"), F.concat("receipts", F.coalesce(F.transform("new", lambda x: x["receipt"]), nothing))).alias("receipts"),
        F.when(left, leaving["body"]).when(F.size("new") > 0, last["body"]).when(~F.col("done"), F.col("body")).alias("body"),
        (F.col("done") | left).alias("done"), ends.alias("ends_ms"),
        F.when(left, F.when(leaving["ok"], "good").otherwise("dead-letter")).alias("route"),
        F.when(left, F.size("receipts") + F.col("at")).cast("int").alias("receives"))


def _clock(messages: DataFrame, keep_ms: int, slack: str) -> int:
    """The time that ends messages: the last arrival less ``slack``."""
    row = messages.agg(F.unix_millis(F.timestamp_millis(F.max("ends_ms") - F.lit(keep_ms)) - F.expr(f"INTERVAL {slack}")).alias("t")).first()
    return row["t"] if row["t"] is not None else 0


def retry_stream(deliveries: DataFrame, sink: str, checkpoint: str, most: int = MAX_RECEIVES,
                 keep_ms: int = _DAYS * 86_400_000, slack: str = "1 hour", available_now: bool = True):
    """ST4: one row for each message that leaves the queue, into ``sink/batch_id=<n>/route=<route>``: ``good``,
    ``dead-letter`` (``retried``), or ``expired`` when nothing has come for ``keep_ms`` after an earlier failure.

    The messages known are a table under the checkpoint, a version for each micro-batch, of which the last two are
    kept: a micro-batch joins its deliveries to the version before and writes its own, so a replay rewrites it. A
    message is let go ``keep_ms`` after its last delivery arrived. The time is that of the last arrival, so none is
    late as long as a restarted job's clock is behind by ``slack`` at most. A micro-batch costs one pass over the
    known messages: choose the trigger by their number."""
    spark = deliveries.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        root = f"{checkpoint}/messages"
        versions = sorted(int(v.rsplit("=", 1)[1]) for v in existing(spark, f"{root}/batch_id=*") if path_exists(spark, f"{v}/_SUCCESS"))
        earlier = [v for v in versions if v < batch_id]
        own = batch.sparkSession
        known = own.createDataFrame([], MESSAGES)
        if earlier:
            known = own.read.schema(MESSAGES).parquet(f"{root}/batch_id={earlier[-1]}")
            known = known.where(F.col("ends_ms") > _clock(known, keep_ms, slack))
        at = f"{root}/batch_id={batch_id}"
        retried(batch, known, most, keep_ms).write.mode("overwrite").parquet(at)
        now = spark.read.schema(MESSAGES).parquet(at)
        ended = ~F.col("done") & (F.col("ends_ms") <= _clock(now, keep_ms, slack))
        out = now.select("message_id", "body", F.when(ended, "expired").otherwise(F.col("route")).alias("route"),
                         F.when(ended, F.size("receipts")).otherwise(F.col("receives")).cast("int").alias("receives"))
        out.where("route IS NOT NULL").withColumn("platform", message_platform(F.col("body"))).write.mode("overwrite") \
            .partitionBy("route").parquet(f"{sink}/batch_id={batch_id}")
        for v in earlier[:-1]:
            remove(spark, f"{root}/batch_id={v}")

    return _start(distinct_deliveries(deliveries, slack), checkpoint, write, available_now)


OUTCOMES = "message_id string, body string, receives int, platform string, batch_id bigint, route string"


def read_outcomes(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.schema(OUTCOMES).parquet(sink).drop("batch_id")

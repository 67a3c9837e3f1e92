"""Lookups by stored order: plans and results; the dashboard cache notices rewritten days."""

import uuid

from pyspark.sql import functions as F

from adlens.functions.dates import partition_keys
from adlens.operators import lookups
from adlens.plans import dashboard as dash
from adlens.session import existing, scratch_path
from adlens.sinks import ordered
from adlens.sinks.tables import write_partitions
from adlens.sources import fixtures as fx

from .conftest import SF


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_bucket_is_read_and_nothing_exchanged(spark):
    messages = fx.chat_messages(spark, SF)
    table = f"t_messages_{uuid.uuid4().hex}"
    ordered.store_ordered(messages, table, scratch_path(spark, "t_messages"), "conversation_id", ["seq", "message_id"], 16)
    one = ordered.messages_of(spark, table, "7")
    plan = plan_of(one)
    assert "SelectedBucketsCount: 1 out of 16" in plan and "Exchange" not in plan
    want = lookups.messages_of(messages, "7").select(*one.columns)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, want.collect())) and one.count() > 0
    spark.sql(f"DROP TABLE {table}")


def test_a_hot_key_is_written_by_several_tasks(spark):
    own = spark.newSession()
    for k, v in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB"), ("spark.sql.shuffle.partitions", "8")):
        own.conf.set(k, v)
    rows = own.range(60_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("user_id"),
                                    F.sha2(F.col("id").cast("string"), 256).alias("conversation_id"), F.col("id").alias("last_seq"))
    table, path = f"t_users_{uuid.uuid4().hex}", scratch_path(spark, "t_users")
    ordered.store_ordered(rows, table, path, "user_id", ["last_seq", "conversation_id"], 8)
    hot = spark.table(table).where("user_id = 'hot'").select(F.input_file_name().alias("f")).distinct().count()
    assert hot > 3
    got = ordered.conversations_of(spark, table, "hot")
    assert got.count() == 40_000 and got.where("position = 1").first().last_seq == 59_999
    spark.sql(f"DROP TABLE {table}")


def test_the_cache_notices_a_rewritten_day(spark):
    table, root = scratch_path(spark, "t_unified"), scratch_path(spark, "t_cache")
    rows = spark.createDataFrame([("google", f"1998-03-{d:02d}", 10.0, 20.0, 5, 2) for d in range(1, 13)],
                                 "media string, d string, cost double, conv_value double, impressions long, clicks long")
    rows = rows.withColumn("report_date", F.col("d").cast("date")).drop("d")
    rows = rows.select("*", *partition_keys("report_date"))
    write_partitions(rows, table)
    as_of = "1998-03-10 00:00:00"

    def runs():
        return existing(spark, f"{root}/tz=*/as_of_hour=*/version=*/run=*")

    first = dash.cached_by_version(spark, table, as_of, root).first()
    assert (first.week_cost, len(runs())) == (20.0, 1)
    dash.cached_by_version(spark, table, as_of, root)
    write_partitions(rows.where("report_date = '1998-03-01'").withColumn("cost", F.lit(7.0)), table)
    assert dash.cached_by_version(spark, table, as_of, root).first() == first and len(runs()) == 1  # another week's day
    write_partitions(rows.where("report_date = '1998-03-09'").withColumn("cost", F.lit(100.0)), table)
    assert dash.cached_by_version(spark, table, as_of, root).first().week_cost == 110.0 and len(runs()) == 2
    dash.cached_by_version(spark, table, "1998-03-10 01:00:00", root)
    assert len(runs()) == 3
    # a writer that ended half way, and a second one at the same time
    half = runs()[0].rsplit("/", 1)[0] + "/run=0"
    rows.limit(1).write.parquet(half)
    spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{half}/_SUCCESS").getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration()).delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{half}/_SUCCESS"), False)
    assert "week_cost" in dash.cached_by_version(spark, table, as_of, root).columns

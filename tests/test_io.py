"""Sources and sinks: rerun safety, encodings, documents."""

import codecs
import datetime as dt
import os

from pyspark.sql import functions as F

from adlens.functions.dates import partition_keys
from adlens.sinks import tables as sinks
from adlens.sources import readers


def _rows(spark, items):
    df = spark.createDataFrame(items, "kwd_id string, imp long, report_date date")
    return df.select("kwd_id", "imp", F.regexp_replace(F.col("report_date").cast("string"), "-", "").alias("basic_date"),
                     "report_date", *partition_keys("report_date"))


def _read(spark, path):
    return sorted((r.kwd_id, r.imp, r.day) for r in readers.scan_table(spark, path, "kakao").collect())


def test_empty_extract_keeps_partition_and_rerun_replaces_day(spark, tmp_dir):
    d1, d2 = dt.date(2024, 3, 4), dt.date(2024, 3, 5)
    sinks.write_partitions(_rows(spark, [("a", 1, d1), ("b", 2, d2)]), tmp_dir)
    first = _read(spark, tmp_dir)
    sinks.write_partitions(_rows(spark, [("a", 1, d1)]).limit(0), tmp_dir)      # empty: no change
    assert _read(spark, tmp_dir) == first
    rerun = _rows(spark, [("c", 9, d2)])
    sinks.write_partitions(rerun, tmp_dir)
    sinks.write_partitions(rerun, tmp_dir)                                     # idempotent
    assert _read(spark, tmp_dir) == [("a", 1, "04"), ("c", 9, "05")]


def test_partition_strings_keep_zero_and_range_prunes(spark, tmp_dir):
    sinks.write_partitions(_rows(spark, [("a", 1, dt.date(2024, 3, 4)), ("b", 2, dt.date(2024, 4, 5))]), tmp_dir)
    df = readers.scan_table(spark, tmp_dir, "kakao", "2024-03-01", "2024-03-31")
    assert [r.month_p for r in df.collect()] == ["03"]
    assert len(df.inputFiles()) == 1 and "month_p=03" in df.inputFiles()[0]   # other days are not listed
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(report_date)" in plan
    none = readers.scan_table(spark, tmp_dir, "kakao", "2025-01-01", "2025-01-31")
    assert none.count() == 0 and none.columns == df.columns


def test_csv_quotes_line_breaks_and_encodings_in_order(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/q", exist_ok=True)
    with open(f"{tmp_dir}/q/a.csv", "w") as f:
        f.write('k,v\n1,"a ""b"", c"\n2,"two\nlines"\n3,x,too many\n')
    df = readers.read_csv_text(spark, f"{tmp_dir}/q", encodings=("UTF-8",), multi_line=True, corrupt="bad")
    rows = {r.k: r.v for r in df.collect()}
    assert rows["1"] == 'a "b", c' and rows["2"] == "two\nlines"
    assert [r.bad is not None for r in df.orderBy("k").collect()] == [False, False, True]
    os.makedirs(f"{tmp_dir}/bad", exist_ok=True)
    with open(f"{tmp_dir}/bad/a.csv", "wb") as f:
        f.write(b"k,v\n1,\xff\xfe\xff\n")
    import pytest
    with pytest.raises(ValueError):
        readers.read_csv_text(spark, f"{tmp_dir}/bad").collect()
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "false"


def test_csv_encodings(spark, tmp_dir):
    text = "kwd_id,camp_name\n1,캠페인\n"
    for name, enc in (("utf8bom", "utf-8-sig"), ("cp949", "cp949")):
        os.makedirs(f"{tmp_dir}/{name}", exist_ok=True)
        with codecs.open(f"{tmp_dir}/{name}/a.csv", "w", encoding=enc) as f:
            f.write(text)
        df = readers.read_csv_text(spark, f"{tmp_dir}/{name}")
        assert df.columns == ["kwd_id", "camp_name"]
        assert [tuple(r) for r in df.collect()] == [("1", "캠페인")]
        assert all(t == "string" for _, t in df.dtypes)


def test_catalog_tables_register_partitions(spark, tmp_dir):
    sinks.write_partitions(_rows(spark, [("a", 1, dt.date(2024, 3, 4))]), f"{tmp_dir}/kakao")
    (name,) = sinks.create_tables(spark, tmp_dir, "t_io", drop_first=True, platforms=("kakao",))
    sinks.register_partitions(spark, name)
    got = readers.sql(spark, f"SELECT kwd_id, imp, year, month_p, day FROM {name}").collect()
    assert [tuple(r) for r in got] == [("a", 1, "2024", "03", "04")]


def test_flatten_kakao_skips_failed_accounts(spark, tmp_dir):
    docs = spark.createDataFrame(
        [("A", "2024-03-05", True, [("k1", "g1", {"imp": "3", "spending": "1.5"})]),
         ("B", "2024-03-05", False, [("k2", "g2", {"imp": "4"})])],
        "account_id string, date string, ok boolean, "
        "data array<struct<keywordId:string, adGroupId:string, metrics:map<string,string>>>")
    docs = docs.select("account_id", "date", "ok", F.transform("data", lambda x: F.struct(
        x.keywordId.alias("keywordId"), x.adGroupId.alias("adGroupId"),
        F.struct(x.metrics["imp"].alias("imp"), x.metrics["spending"].alias("spending")).alias("metrics"))).alias("data"))
    docs.write.json(tmp_dir)
    flat = readers.flatten_kakao(readers.read_responses(spark, tmp_dir, "kakao")).collect()
    assert [(r.kwd_id, r.adv_id, r.basic_date, r.imp, r.spending, r.click) for r in flat] == \
        [("k1", "A", "20240305", 3, 1.5, 0)]


def test_batch_load_replaces_day_and_ignores_empty(spark, tmp_dir):
    import json
    import os
    from adlens.plans.loads import batch_load

    def land(path, impressions):
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/r.json", "w") as f:
            results = [{"campaign": {"id": 7, "name": "c"}, "adGroupCriterion": {"criterionId": "k"},
                        "metrics": {"impressions": str(i), "costMicros": "2500000"}} for i in impressions]
            f.write(json.dumps({"results": results}) + "\n")
    table = f"{tmp_dir}/table"
    land(f"{tmp_dir}/d1", [1, 2])
    batch_load(spark, "google", f"{tmp_dir}/d1", table, date="2024-03-05", customer_id="123-45")
    land(f"{tmp_dir}/d2", [9])
    batch_load(spark, "google", f"{tmp_dir}/d2", table, date="2024-03-05", customer_id="123-45")
    land(f"{tmp_dir}/d3", [])
    batch_load(spark, "google", f"{tmp_dir}/d3", table, date="2024-03-05", customer_id="123-45")
    rows = readers.scan_table(spark, table, "google").collect()
    assert [(r.impressions, r.basic_date, r.adv_id, r.camp_id, r.cost_micros, r.creation_id) for r in rows] == \
        [(9, "20240305", "12345", "7", 2500000.0, None)]


def test_hot_day_is_split_across_writer_tasks(spark, tmp_dir):
    """A day holding most rows is written by several tasks (AQE splits the
    skewed rebalance partition), other days stay one file each."""
    import glob
    hot = spark.range(40000).select(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")).alias("kwd_id"),
                                    F.col("id").alias("imp"), F.lit(dt.date(2024, 3, 5)).alias("report_date"))
    cold = spark.range(20).select(F.lit("c").alias("kwd_id"), F.col("id").alias("imp"),
                                  F.date_add(F.lit(dt.date(2024, 4, 1)), F.col("id").cast("int")).alias("report_date"))
    rows = hot.unionByName(cold)
    rows = rows.select("kwd_id", "imp", "report_date", *partition_keys("report_date"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        sinks.write_partitions(rows, tmp_dir)
    finally:
        spark.conf.set(key, before)
    hot_files = glob.glob(f"{tmp_dir}/year=2024/month_p=03/day=05/*.parquet")
    assert len(hot_files) > 1
    assert readers.scan_table(spark, tmp_dir, "kakao").count() == 40020


def test_bulk_load_counts_stages_without_extra_jobs(spark, tmp_dir):
    import os
    from adlens.plans.loads import bulk_load
    os.makedirs(f"{tmp_dir}/kw", exist_ok=True)
    os.makedirs(f"{tmp_dir}/m", exist_ok=True)
    with open(f"{tmp_dir}/kw/a.csv", "w") as f:
        f.write("kwd_id,imp,basic_date\n1,2.5,20240305\n2,3.5,2024-03-06\n3,x,bad\n1,1,20240305\n")
    with open(f"{tmp_dir}/m/a.csv", "w") as f:
        f.write("kwd_id,camp_name,seq\n1,old,1\n1,new,2\n")
    res = bulk_load(spark, "kakao", f"{tmp_dir}/kw", f"{tmp_dir}/t", f"{tmp_dir}/q", master_path=f"{tmp_dir}/m",
                    master_seq="seq")
    assert res["counts"]() == {"read": 4, "enriched": 4, "written": 3, "quarantined": 1}
    rows = sorted((r.kwd_id, r.imp, r.camp_name, r.basic_date) for r in readers.scan_table(
        spark, f"{tmp_dir}/t", "kakao").collect())
    assert rows == [("1", 1, "new", "2024-03-05"), ("1", 2, "new", "2024-03-05"), ("2", 4, None, "2024-03-06")]


def test_cached_dashboard_reuses_the_hour(spark, tmp_dir):
    from adlens.catalog import _unified
    from adlens.plans.dashboard import cached_dashboard

    from .conftest import SF
    builds = []

    def unified():
        builds.append(1)
        return _unified(spark, SF)
    first = sorted(map(tuple, cached_dashboard(spark, unified, "1998-03-10 00:00:00", tmp_dir, SF).collect()))
    second = sorted(map(tuple, cached_dashboard(spark, unified, "1998-03-10 00:30:00", tmp_dir, SF).collect()))
    assert first == second and len(builds) == 1
    cached_dashboard(spark, unified, "1998-03-10 01:00:00", tmp_dir, SF).collect()
    assert len(builds) == 2
    cached_dashboard(spark, unified, "1998-03-10 00:00:00", tmp_dir, SF, tz="UTC").collect()
    cached_dashboard(spark, unified, "1998-03-10 00:00:00", tmp_dir, "other").collect()
    assert len(builds) == 4


def test_master_without_sequence_keeps_the_last_row_in_file_order(spark, tmp_dir):
    from adlens.plans.loads import read_master
    os.makedirs(tmp_dir, exist_ok=True)
    for name, rows in (("a.csv", ["1,old", "2,x", "1,mid"]), ("b.csv", [" 1 ,new", "3,y"])):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write("kwd_id,camp_name\n" + "\n".join(rows) + "\n")
    got = sorted(map(tuple, read_master(spark, tmp_dir).collect()))
    assert got == [("1", "new"), ("2", "x"), ("3", "y")]


def test_undated_batch_rows_go_to_quarantine(spark, tmp_dir):
    import json
    from adlens.plans.loads import batch_load
    os.makedirs(f"{tmp_dir}/d", exist_ok=True)
    with open(f"{tmp_dir}/d/r.json", "w") as f:
        f.write(json.dumps({"results": [{"segments": {"date": d}, "metrics": {"impressions": "1"}}
                                        for d in ("2024-03-05", "never")]}) + "\n")
    for _ in range(2):
        batch_load(spark, "google", f"{tmp_dir}/d", f"{tmp_dir}/t", quarantine=f"{tmp_dir}/q")
    assert [r.day for r in readers.scan_table(spark, f"{tmp_dir}/t", "google").collect()] == ["05"]
    assert [r.basic_date for r in spark.read.parquet(f"{tmp_dir}/q").collect()] == ["never"]


def test_landed_google_documents_are_compressed_and_packed_from_plain_values(spark, tmp_dir):
    """What is shuffled and written for a row does not hold the names and fixed texts of its document."""
    from adlens.catalog import QUERIES
    from adlens.sources import landed
    spark.sql("""SELECT id AS l_orderkey, id % 3 AS l_partkey, 1 AS l_linenumber, 2.0D AS l_quantity, 3.5D AS l_extendedprice,
        0.1D AS l_discount, 'A' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP_NTZ'1998-03-05 00:00:00' AS l_shipdate
        FROM range(250)""").write.parquet(f"{tmp_dir}/lineitem.parquet")
    spark.sql("SELECT id AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 't' AS p_type, 1 AS p_size FROM range(3)").write.parquet(
        f"{tmp_dir}/part.parquet")
    flat = QUERIES["json_flatten"](spark, tmp_dir)
    assert flat.count() == 250 and flat.inputFiles() and all(f.endswith(".json.gz") for f in flat.inputFiles())
    assert sorted(len(r.results) for r in landed.google_documents(spark, tmp_dir).collect()) == [50, 100, 100]
    assert [len(r.results) for r in landed.google_day_documents(spark, tmp_dir).collect()] == [250]
    for docs in (landed.google_documents(spark, tmp_dir), landed.google_day_documents(spark, tmp_dir)):
        plan = docs._jdf.queryExecution().optimizedPlan().toString()
        gathered = plan.split("collect_list(")[1].split("lambdafunction")[0]
        assert "transform(collect_list(" in plan and "costMicros" not in gathered


def _google_tables(spark, path, rows=250):
    spark.sql(f"""SELECT id AS l_orderkey, id % 3 AS l_partkey, 1 AS l_linenumber, 2.0D AS l_quantity, 3.5D AS l_extendedprice,
        0.1D AS l_discount, 'A' AS l_returnflag, 'F' AS l_linestatus,
        TIMESTAMP_NTZ'1998-03-05 00:00:00' + make_dt_interval(CAST(id % 4 AS INT)) AS l_shipdate
        FROM range({rows})""").write.parquet(f"{path}/lineitem.parquet")
    spark.sql("SELECT id AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 't' AS p_type, 1 AS p_size FROM range(3)").write.parquet(
        f"{path}/part.parquet")


def _shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(blocks.size()) if (name := blocks.apply(i).getName()).startswith("shuffle_")}


def test_a_load_leaves_no_shuffle_files(spark, tmp_dir):
    """Documents and table are written with shuffles whose files go when each write ends."""
    import time
    from adlens.catalog import QUERIES
    _google_tables(spark, tmp_dir)
    known = _shuffle_files(spark)
    loaded = QUERIES["batch_load_google"](spark, tmp_dir)
    time.sleep(2)      # they are removed in the background
    assert not _shuffle_files(spark) - known
    assert loaded.count() == 250 and loaded.select("basic_date").distinct().count() == 4


def test_a_load_moves_and_stages_no_column_that_the_date_tells(spark, tmp_dir, monkeypatch):
    import json
    from adlens.plans import loads
    from adlens.sinks import tables
    staged, dealt = [], []
    monkeypatch.setattr(loads, "scratch_path", lambda s, name: staged.append(f"{tmp_dir}/{name}") or staged[-1])
    write = loads.write_partitions
    monkeypatch.setattr(loads, "write_partitions", lambda df, path, **kw: dealt.append(kw) or write(df, path, **kw))
    os.makedirs(f"{tmp_dir}/d", exist_ok=True)
    with open(f"{tmp_dir}/d/r.json", "w") as f:
        f.write(json.dumps({"results": [{"segments": {"date": d}, "metrics": {"impressions": "1"}}
                                        for d in ("2024-03-05", "20240306", "never", None)]}) + "\n")
    good = loads.batch_load(spark, "google", f"{tmp_dir}/d", f"{tmp_dir}/t", quarantine=f"{tmp_dir}/q")
    kept = spark.read.parquet(staged[0])
    assert not set(tables.PARTITION_COLUMNS) & set(kept.columns) and "basic_date" in kept.columns
    assert dealt[0]["by"] == "report_date" and set(dealt[0]["remade"]) == {"basic_date", *tables.PARTITION_COLUMNS}
    rows = lambda df: sorted(map(tuple, df.select("basic_date", "date", "report_date", "year", "month_p", "day").collect()))
    expected = [("20240305", "2024-03-05", dt.date(2024, 3, 5), "2024", "03", "05"),
                ("20240306", "20240306", dt.date(2024, 3, 6), "2024", "03", "06")]
    assert rows(good) == expected == rows(readers.scan_table(spark, f"{tmp_dir}/t", "google"))
    assert good.columns[-4:] == ["report_date", "year", "month_p", "day"]
    assert sorted((r.basic_date, r.report_date, r.year, r.day) for r in spark.read.parquet(f"{tmp_dir}/q").collect()) == \
        [("", None, None, None), ("never", None, None, None)]


def test_rows_are_moved_to_their_document_before_they_are_gathered(spark, tmp_dir):
    from adlens.sources import landed
    _google_tables(spark, tmp_dir)
    for docs in (landed.google_documents(spark, tmp_dir), landed.google_day_documents(spark, tmp_dir)):
        plan = docs._jdf.queryExecution().executedPlan().toString()
        partial = plan.index("partial_collect_list")
        assert partial < plan.index("REPARTITION_BY_COL") and plan.count("Exchange hashpartitioning") == plan[partial:].count("Exchange hashpartitioning")

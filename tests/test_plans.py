"""Plan checks: pushdown, pruning, no Python UDF anywhere, top-k operator."""

import pytest

from adlens.catalog import QUERIES

from .conftest import SF

# queries that write documents or tables before reading them back
WRITE_QUERIES = {"parquet_roundtrip", "rewrite_day", "catalog_scan", "csv_roundtrip", "json_flatten",
                 "accounts", "stream_failed_counts", "stream_routes", "stream_ingest", "report_datasets",
                 "report_texts", "report_pie", "report_titles", "sheets_roundtrip", "doc_kpi",
                 "doc_week_of_month", "doc_daily_sheet", "google_top10_from_table", "bulk_load_kakao",
                 "active_reports", "reports_by_month", "conversations_with_report", "stream_untimed_counts", "dashboard_cached",
                 "bulk_load_kakao_file_order", "bulk_load_google", "batch_load_kakao", "batch_load_google",
                 "kakao_top10_from_table", "media_totals_named", "stream_redelivered_counts", "doc_google_sheet",
                 "doc_kakao_sheet", "doc_media_share"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITE_QUERIES))
def test_no_python_udf(spark, name):
    p = plan_of(QUERIES[name](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_week_filter_reaches_scan(spark):
    df = QUERIES["google_campaign_top10"](spark, SF)
    p = plan_of(df)
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p
    assert "TakeOrderedAndProject" in p


def test_column_pruning(spark):
    df = QUERIES["google_campaign_top10"](spark, SF)
    p = plan_of(df)
    assert "l_tax" not in p and "p_retailprice" not in p


def test_weekly_report_scans_each_table_once(spark):
    df = QUERIES["weekly_report"](spark, SF)
    df.collect()
    p = plan_of(df)
    assert "isFinalPlan=true" in p and p.count("ReusedExchange") >= 2


def test_table_path_prunes_partitions(spark):
    df = QUERIES["google_top10_from_table"](spark, SF)
    days = {f.split("/day=")[1][:2] for f in df.inputFiles()}
    assert days <= {f"{d:02d}" for d in range(2, 9)} and len(df.inputFiles()) < 30   # no other day is listed
    assert "PushedFilters: [IsNotNull(report_date)" in plan_of(df)


def test_positions_scan_the_rows_without_partition_ids(spark):
    p = plan_of(QUERIES["messages_in_order"](spark, SF))
    assert "rangepartitioning" not in p and "SPARK_PARTITION_ID" not in p


def test_kpi_is_one_scan_of_each_table(spark):
    df = QUERIES["kpi_totals"](spark, SF)
    df.collect()
    p = plan_of(df).split("== Initial Plan ==")[0]
    assert p.count("lineitem.parquet") == 1 and p.count("orders.parquet") == 1


def test_no_udf_defined_in_the_package():
    import pathlib
    root = pathlib.Path(__file__).resolve().parent.parent / "adlens"
    for f in root.rglob("*.py"):
        if "llm" in f.parts:     # text operators: Python where their methods need it
            continue
        text = f.read_text()
        for word in ("F.udf", "pandas_udf", "@udf", "mapInPandas", "applyInPandas", ".rdd."):
            assert word not in text, f"{word} in {f}"

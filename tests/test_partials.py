"""Stored daily sums equal the scan; a rewritten day changes its own only. SQL binds values and only reads."""

import datetime

import pytest
from pyspark.sql import functions as F

from adlens.operators.sets import unify_media
from adlens.plans import dashboard, partials, sheets, weekly
from adlens.session import existing, scratch_path
from adlens.sinks.tables import write_partitions
from adlens.functions.dates import partition_keys
from adlens.sources import fixtures as fx
from adlens.sources import readers

from .conftest import SF

AS_OF = "1998-03-10 00:00:00"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def root(spark):
    out = scratch_path(spark, "t_sums")
    partials.refresh(fx.google_ads(spark, SF), "google", f"{out}/google")
    partials.refresh(fx.kakao_facts(spark, SF), "kakao", f"{out}/kakao")
    return out


def test_reports_equal_the_scan(spark, root):
    g, k, m = fx.google_ads(spark, SF), fx.kakao_facts(spark, SF), fx.kakao_master(spark, SF)
    assert rows(partials.weekly_report(spark, root, m, AS_OF)) == rows(weekly.weekly_report(g, k, m, AS_OF))
    assert rows(partials.campaign_top(spark, root, "1998-03-02", "1998-03-08")) == rows(weekly.google_top(g))
    assert partials.stored(spark, f"{root}/google", "google", "2050-01-01", "2050-01-09").count() == 0
    assert partials.overall_by_media(spark, root, "2050-01-01", "2050-01-02").count() == 2


def test_dashboard_and_sheets_equal_the_scan(spark, root):
    u = unify_media(fx.google_ads(spark, SF), fx.kakao_facts(spark, SF))
    for as_of in (AS_OF, "1998-03-15 18:00:00", "1992-01-01 00:00:00"):
        assert rows(partials.dashboard_media(spark, root, as_of)) == rows(dashboard.dashboard_media(u, as_of))
        assert rows(partials.conversion_trend(spark, root, as_of)) == rows(dashboard.conversion_trend(u, as_of))
        assert rows(partials.week_over_week(spark, root, as_of)) == rows(sheets.week_over_week_as_of(u, as_of))
    week = ("1998-02-23", "1998-03-08")
    assert rows(partials.media_spend(spark, root, *week)) == rows(sheets.media_spend(u, *week))
    assert rows(partials.daily_sheet(spark, root, *week)) == rows(sheets.daily_sheet(u, *week))
    assert partials.dashboard_media(spark, root, "2050-01-05 00:00:00").count() == 0
    two = partials.unified(spark, root, "1998-03-09", "1998-03-10").inputFiles()
    assert two and {f.split("report_date=")[1][:10] for f in two} <= {"1998-03-09", "1998-03-10"}


def test_a_week_reads_its_days_only(spark, root):
    week = partials.stored(spark, f"{root}/google", "google", "1998-02-26", "1998-03-04")
    files = week.inputFiles()
    assert {f.split("report_date=")[1][:10] for f in files} <= {str(datetime.date(1998, 2, 26) + datetime.timedelta(days=i)) for i in range(7)}
    assert 0 < len(files) <= 7


def test_a_rewritten_day_refreshes_only_itself(spark):
    table, sums = scratch_path(spark, "t_facts"), scratch_path(spark, "t_sums")
    g = fx.google_ads(spark, SF).where("report_date BETWEEN '1998-03-01' AND '1998-03-31'")
    g = g.select("camp_name", "impressions", "clicks", "cost_micros", "conversions", "conversions_value", "report_date",
                 *partition_keys("report_date"))
    write_partitions(g, table)
    partials.refresh_days(spark, table, "google", sums, g)
    before = {p: existing(spark, f"{p}/*.parquet") for p in existing(spark, f"{sums}/report_date=*")}
    day = g.where("report_date = '1998-03-05'").withColumn("clicks", F.col("clicks") * 3)
    write_partitions(day, table)
    partials.refresh_days(spark, table, "google", sums, day)
    after = {p: existing(spark, f"{p}/*.parquet") for p in existing(spark, f"{sums}/report_date=*")}
    assert {p[-10:] for p in after if after[p] != before.get(p)} == {"1998-03-05"}
    want = readers.scan_table(spark, table, "google", "1998-03-01", "1998-03-31").agg(F.sum("clicks")).first()[0]
    assert partials.stored(spark, sums, "google", "1998-03-01", "1998-03-31").agg(F.sum("clicks")).first()[0] == want
    assert partials._ranges([datetime.date(2020, 2, 28), datetime.date(2020, 2, 29), datetime.date(2020, 3, 2)]) == [
        (datetime.date(2020, 2, 28), datetime.date(2020, 2, 29)), (datetime.date(2020, 3, 2),) * 2]


def test_values_are_bound_and_statements_only_read(spark):
    spark.createDataFrame([("a'; DROP TABLE x", 1), ("b", 2)], "name string, n int").createOrReplaceTempView("t_bound")
    got = readers.sql(spark, "SELECT n FROM t_bound WHERE name = :name", name="a'; DROP TABLE x").collect()
    assert [r.n for r in got] == [1]
    assert readers.sql(spark, "WITH q AS (SELECT 1 AS x) SELECT * FROM q").count() == 1
    assert readers.sql(spark, "SHOW TABLES").count() >= 1
    for text in ("DROP VIEW t_bound", "INSERT INTO t_bound VALUES ('x', 1)", "WITH q AS (SELECT 1) INSERT INTO t_bound SELECT 'x', 1",
                 "CREATE TABLE z AS SELECT 1 AS a", "SET spark.sql.ansi.enabled = false", "CACHE TABLE t_bound",
                 "FROM t_bound INSERT INTO t_bound SELECT name, n"):
        with pytest.raises(ValueError, match="only statements that read"):
            readers.sql(spark, text)
    with pytest.raises(Exception, match="UNBOUND_SQL_PARAMETER"):
        readers.sql(spark, "SELECT :missing")

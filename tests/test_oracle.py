"""Every registered query against its DuckDB SQL on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from adlens import catalog  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

from .conftest import SF  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(entry.oracle_sql()) >= set(catalog.QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["camp_name", "impressions", "clicks", "ctr", "cost", "conversions",
                          "conversions_value", "cost_per_conversion"]


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(catalog.QUERIES)))
def test_query_equals_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]

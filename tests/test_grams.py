"""Substring search by stored trigrams: the rows of ``contains``, from fewer blocks."""

import re

import pytest
from pyspark.sql import functions as F

from adlens.operators.filters import search
from adlens.session import scratch_path
from adlens.sinks import grams
from adlens.sources import fixtures as fx

from .conftest import SF

TEXTS = ["Red shoes", "red SHOES", "blue", "ab", "", None, "naïve Käse", "東京タワー", "shoes red", "aaaa", "a%b_c", "Red shoes",
         "İstanbul", "ΣΑΣ σας", "x" * 5000 + "needle" + "y" * 5000]


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.fixture(scope="module")
def small(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, title string")
    path = scratch_path(spark, "t_grams")
    grams.store_searchable(rows, path, "title", 4)
    return rows, path


@pytest.mark.parametrize("text", ["red", "RED SH", "shoes", "oes r", "", "a", "ab", "aaa", "aaaaa", "%b_", "käse", "東京タ",
                                  "タワー", "istanbul", "σας", "xneedley", "no such", "%%%"])
def test_same_rows_as_contains(spark, small, text):
    rows, path = small
    assert ids(grams.find(spark, path, "title", text)) == ids(search(rows, "title", text))


def test_rare_texts_read_fewer_blocks(spark):
    rows = fx.google_ads(spark, SF).select("keyword_id", "keyword_text").withColumn("id", F.col("keyword_id").cast("long"))
    path = scratch_path(spark, "t_grams")
    grams.store_searchable(rows, path, "keyword_text", 32)
    one = rows.agg(F.min("keyword_text")).first()[0]
    sizes = {}
    for text in (one, one[:4], "e"):
        found = grams.find(spark, path, "keyword_text", text)
        want = ids(search(rows, "keyword_text", text))
        assert ids(found) == want and want
        blocks = grams.blocks_with(spark, path, text)
        sizes[text] = 32 if blocks is None else len(blocks)
        if blocks is not None:  # the folders of other blocks are not read
            assert re.search(r"PartitionFilters: \[[^\]]*_block#", found._jdf.queryExecution().executedPlan().toString())
    assert sizes[one] <= sizes[one[:4]] <= sizes["e"] == 32 and sizes[one] <= 4
    assert grams.blocks_with(spark, path, "zzzqqq") == []


def test_a_text_in_most_rows_takes_several_blocks(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 3 > 0, "the same title").otherwise(
        F.concat(F.lit("title "), "id")).alias("title"))
    path = scratch_path(spark, "t_grams")
    grams.store_searchable(rows, path, "title", 16)
    n = spark.read.parquet(f"{path}/rows").groupBy("_block").count()
    assert n.agg(F.max("count")).first()[0] < 20_000 / 16 * 2
    assert grams.find(spark, path, "title", "SAME").count() == rows.where("id % 3 > 0").count()


def test_empty_table(spark):
    path = scratch_path(spark, "t_grams")
    grams.store_searchable(spark.createDataFrame([], "id long, title string"), path, "title", 4)
    assert spark.read.schema("gram string, _block int").parquet(f"{path}/postings").count() == 0
    assert grams.find(spark, path, "title", "abc").collect() == [] == grams.find(spark, path, "title", "a").collect()

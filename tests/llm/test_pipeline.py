"""The pipeline and the registered queries against stage-by-stage expectations."""

import hashlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer as Library

import __spark_entry__ as entry
import corpus_pipeline
from adlens.llm.queries import QUERIES, vocabulary

from ..conftest import SF
from .cases import SCHEMA, frame


def test_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_join", "tiling", "surrogates", "bpe_tree"]


@pytest.mark.parametrize("name", ["op6_host_rules", "op7_shard_tree"])
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(tuple, df.select(*cols).collect()), key=str) == sorted(res.fetchall(), key=str)


def test_stages_on_awkward_rows(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(380, 400)))], "item_id long, text string")
    bench.write.parquet(f"{root}/benchmark.parquet")
    docs = frame(spark).cache()
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, root)
        if name != "bpe_tree":
            assert out.columns == docs.columns
        kept[name] = sorted((r.doc_id for r in out.collect()), key=str)
        docs = out.cache()
    # null, empty, white and letterless texts go; copies 2 and 8 and one repeated 6; the item's document 7
    assert kept["language_id"] == sorted([1, 2, 6, 6, 7, 8, 9, 10, None], key=str)
    assert kept["ngram_join"] == sorted([1, 6, 7, 9, 10, None], key=str)
    assert kept["tiling"] == kept["surrogates"] == kept["bpe_tree"] == sorted([1, 6, 9, 10, None], key=str)
    lib = Library.from_file(vocabulary("word_bpe_49k.json"))
    for r in docs.collect():
        if r.doc_id == 6:
            ids = lib.encode("one two", add_special_tokens=False).ids
            assert bytes(r.ids) == np.array(ids, "<u4").tobytes()
            assert r.ids_sha256 == hashlib.sha256(bytes(r.ids)).hexdigest()


def test_stages_on_an_empty_table(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, root)
        assert docs.count() == 0


def test_run_on_the_small_table(spark):
    con = duckdb.connect()
    clean = {i for i, in con.execute(
        f"SELECT doc_id FROM '{SF}/documents.parquet' d WHERE NOT EXISTS (SELECT 1 FROM '{SF}/benchmark.parquet' b "
        "WHERE contains(lower(d.text), lower(b.text)))").fetchall()}
    first = {i for i, in con.execute(f"SELECT min(doc_id) FROM '{SF}/documents.parquet' GROUP BY text").fetchall()}
    got = [r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()]
    assert len(got) == len(set(got)) and set(got) <= clean & first
    assert len(got) >= 0.8 * len(clean & first)      # near copies go too

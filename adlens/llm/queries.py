"""Registered queries: one ``opN_<name>`` per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.session import scratch_path

from . import (bpe_tree, conv_text, host_rules, kd_words, line_index, ngram_join, ordinal, rank_order, shard_tree,
               surrogates, tiling, token_cache, vp_clusters)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; the files lie outside this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ngram_join.join(documents(spark, sf_dir), k=4, percent=85)
    return rows.select("doc_id", "n_shingles", "component_id", "n_links")


#: Production jobs take the key from their secret store; results under one key agree.
SURROGATE_KEY = "corpus-key-1"


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_entities(documents(spark, sf_dir).select("doc_id", "text"), SURROGATE_KEY)


def op3_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return tiling.contaminated(documents(spark, sf_dir), tests, short=True).drop("row_key")


def op4_conv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = rank_order.held_out(4, 2)
    model = conv_text.train(docs.where(~out), labels.where(~out))
    return conv_text.classify(docs.select("doc_id", "text"), model).select(
        "doc_id", out.alias("held_out"), "score", "predicted")


def op5_rank_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    out = rank_order.held_out(3, 1)
    profiles = rank_order.learn(docs.where(~out))
    rows = rank_order.identify(docs.select("doc_id", "text"), profiles)
    return rows.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = host_rules.apply_host_rules(documents(spark, sf_dir))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "n_rules_failed", "kept")


def op7_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_tree.shard_documents(documents(spark, sf_dir), shard_tree.tree(2, 2, 2))


def op8_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.digests(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


def op9_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    path, cache = vocabulary("byte_bpe_50k.json"), scratch_path(spark, "token-cache")
    # Two deliveries share the cache: the counts of the first one are joined, not made again, when all are counted.
    first = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    token_cache.fill_cache(docs.where(first), path, cache)
    counted = token_cache.count_tokens(docs, path, cache)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def grades(labels: DataFrame) -> DataFrame:
    """Ratings 0..3 from the two labels: good quality counts 2, not toxic 1."""
    grade: Column = 2 * F.col("quality") + (1 - F.col("toxic"))
    return labels.select("doc_id", grade.alias("grade"))


def op10_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = ordinal.train(docs, grades(labels))
    return ordinal.score(docs.select("doc_id", "text"), model, wanted=2).select(
        "doc_id", "expected_grade", "tail_probability", "selected")


def op11_line_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_index.digests(documents(spark, sf_dir), min_docs=10, chars=1)


def op12_vp_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_clusters.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=16, rounds=3)


def op13_kd_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = kd_words.word_counts(documents(spark, sf_dir), least_chars=6, least_n=5, damage=199)
    return kd_words.group_variants(words, ratio=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_surrogates": op2_surrogates,
    "op3_tiling": op3_tiling,
    "op4_conv_text": op4_conv_text,
    "op5_rank_order": op5_rank_order,
    "op6_host_rules": op6_host_rules,
    "op7_shard_tree": op7_shard_tree,
    "op8_bpe_tree": op8_bpe_tree,
    "op9_token_cache": op9_token_cache,
    "op10_ordinal": op10_ordinal,
    "op11_line_index": op11_line_index,
    "op12_vp_clusters": op12_vp_clusters,
    "op13_kd_words": op13_kd_words,
}

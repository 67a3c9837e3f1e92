"""The corpus pipeline: five stages over ``documents``, each by one operator of ``adlens.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet to the shared folder and read again as the next one's docs.
All but the last return the columns of documents. Nulls, empty texts, repeated
rows and empty tables have the results that the operators' docstrings define;
a text without a letter (or null) is rejected by the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm import bpe_tree, ngram_join, rank_order, surrogates, tiling
from adlens.llm.queries import SURROGATE_KEY, documents, vocabulary
from adlens.llm.store import saved

#: Texts whose ranking is this far from every profile are in no known language.
LEAST_SCORE = 0.1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a known language; unlabelled ones get the one found."""
    profiles = rank_order.learn(docs)
    told = rank_order.identify(docs, profiles)
    kept = told.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near copies (5-word shingles, 0.8)."""
    return ngram_join.keep_one(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that cover a test item."""
    return tiling.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), short=True)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data; n_chars follows the new text."""
    done = surrogates.replace_entities(docs, SURROGATE_KEY)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast("long"))
    return done.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and digests of the ids and of the text they decode to."""
    coded = bpe_tree.encode(docs, vocabulary("word_bpe_49k.json"))
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
                        "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("ngram_join", near_duplicates),
    ("tiling", decontamination),
    ("surrogates", personal_data),
    ("bpe_tree", tokens),
]

#: The stages need trained profiles, tries and BPE, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

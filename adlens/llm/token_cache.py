"""Operator 9: token counts through a digest cache.

A text is known by the SHA-256 of its content and a tokenizer by the SHA-256
of its file. Counts already in the cache are joined; only distinct unknown
texts are encoded, one row each, and their counts are appended.

The tokenizer has no normal form of its own (white space, case and composed
letters all change its tokens), so the content is normalised only where the
count cannot change: a null is the empty text.

Defined results
---------------
* null and empty texts: 0 bytes, 0 tokens; empty table: empty result.
* repeated rows and copies: encoded once, returned once per row; a copy that
  makes up a large part of the rows is pre-aggregated before the shuffle, and
  the join back to documents is split by Spark where a digest is hot.
* null or repeated doc_id: ids only choose which copy is encoded; they are
  compared null-safe together with the digest.
* very long texts: encoded whole; where the fast encoder refuses a text (its
  pattern search can run out of stack) the reference library counts it.
* a cache that holds a digest twice (two jobs at once): read once.
* extra columns are carried; n_bytes, n_tokens and over_limit are replaced.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe_tree import _byte_chars
from .idmap import marked
from .store import fresh as own_name, saved

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens bigint"
RESERVED = ("n_bytes", "n_tokens", "over_limit")

_encoders: dict[str, Counter] = {}


class Counter:
    """Counts the tokens of a text as the library does for a byte-level BPE file."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            raw = f.read()
        spec = json.loads(raw)
        self.library = Tokenizer.from_str(raw)
        back = str.maketrans({c: chr(b) for b, c in _byte_chars().items()})
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {w.translate(back).encode("latin-1"): i for w, i in spec["model"]["vocab"].items() if w not in special}
        # fixed value: the word pattern of this kind of byte-level vocabulary
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> int:
        try:
            return len(self.fast.encode(text, allowed_special="all"))
        except Exception:  # the pattern search can give up on one huge run of letters
            return len(self.library.encode(text, add_special_tokens=False).ids)


def counter(path: str) -> Counter:
    if path not in _encoders:
        _encoders[path] = Counter(path)
    return _encoders[path]


def version(path: str) -> str:
    """Digest of the tokenizer file: another file never reuses this one's counts."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _known(spark, cache_dir: str, tokenizer: str) -> DataFrame:
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache_dir).where(F.col("tokenizer") == tokenizer)
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.encode(_body(text), "UTF-8"), 256))


def _body(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def fill_cache(docs: DataFrame, path: str, cache_dir: str, id: str = "doc_id", text: str = "text") -> None:
    """Appends the counts of the distinct texts of ``docs`` that ``cache_dir`` does not hold.

    Only ids and digests are grouped and joined. A fixed-size map of the ids
    of the copies to encode then thins out the documents, so that texts whose
    count is stored, and further copies of a text, are not shuffled.
    """
    spark = docs.sparkSession
    tokenizer = version(path)
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_dir)
    keyed = docs.select(F.col(id).alias("i"), _digest(text).alias("digest"))
    reps = keyed.groupBy("digest").agg(F.min("i").alias("i"))
    misses = saved(reps.join(_known(spark, cache_dir, tokenizer), "digest", "left_anti"), "token_misses")
    near = marked(docs.select(F.col(id).alias("i"), F.col(text).alias("x")), "i", misses.select("i"))
    texts = near.select("i", _body("x").alias("t"), _digest("x").alias("digest"))
    todo = texts.alias("a").join(misses.alias("m"), (F.col("a.digest") == F.col("m.digest"))
                                 & F.col("a.i").eqNullSafe(F.col("m.i")), "left_semi")

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for b in batches:
            n = [count(x.as_py()) for x in b.column("t")]
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(n, pa.int64())], names=["digest", "n_tokens"])

    fresh = todo.select("digest", "t").mapInArrow(encode, "digest binary, n_tokens bigint")
    (fresh.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))  # rows repeated with their id
     .select(F.lit(tokenizer).alias("tokenizer"), "digest", "n_tokens")
     .write.mode("append").parquet(cache_dir))


def count_tokens(docs: DataFrame, path: str, cache_dir: str, id: str = "doc_id", text: str = "text",
                 limit: int = 512) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit; ``cache_dir`` gains the new counts.

    The cache is a Parquet folder in shared storage; it is made if missing.
    """
    spark = docs.sparkSession
    rows = docs.select(*[c for c in docs.columns if c not in RESERVED])
    fill_cache(rows, path, cache_dir, id, text)
    key = own_name(rows, "digest")
    counts = saved(_known(spark, cache_dir, version(path)).withColumnRenamed("digest", key), "token_counts")
    return (rows.withColumn(key, _digest(text)).withColumn("n_bytes", F.octet_length(_body(text)).cast("long"))
            .join(counts, key, "left").withColumn("over_limit", F.col("n_tokens") > limit).drop(key))

"""Operator 1: n-gram Jaccard self-join through prefix trees.

Every document becomes its set of distinct k-word shingles (64-bit hashes).
Two documents are linked when 100 * intersection >= percent * union. The join
is exact on the sets; equal sets are one set throughout and never paired.

1. Sketch. One pass over the texts writes, for every document, its set's
   digest, size and the first tokens in the global (hash) order: the prefix of
   length n - ceil(percent * n / 100) + 1 and ``slack`` percent more. Two
   linked sets share at least one token of the prefix, and at least
   1 + slack/100 * (smaller size) tokens of the longer one.
2. Filter. Tokens of only one set do not count; sets left with fewer tokens
   than that second bound can have no partner. Most documents end here. The
   sets of the others are read whole, and only those with the wanted percentage
   of their tokens in other such sets go on: few but the linked ones.
3. Blocks. The sets that share a prefix token and are of similar size are a
   group; a group is placed in the block of its least member, and then of the
   least member of any group that its members are in (``ROUNDS`` times), so
   the many tokens shared by a family lead to one block, not one each.
4. Trie join. Blocks are cut into chunks of bounded size; each pair of chunks
   is one group, where one chunk is stored in a trie and the other descends it
   (``trie.similar_pairs``). Groups return one row per set: its links and the
   least set it is connected with, never the pairs.
5. Components of these rows, then the least doc_id of each.

Defined results
---------------
* null, empty or word-less text: n = 0, linked with nothing, its own component.
* null doc_id: the row takes part; it is returned with its null id, and a
  component's id is the least non-null one. A row with no link and a null id
  has a null component.
* repeated rows and exact copies: one set; each row is returned.
* a hot set, token or block: aggregated before the shuffle, joined between
  written tables (Spark splits hot keys), or cut into chunks.
* empty table: empty result. Extra columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .graph import components
from .idmap import marked
from .store import SMALL_BATCHES, fresh, saved
from .trie import similar_pairs, spanning

SLACK = 5
ROUNDS = 1
#: Bounds of a chunk: a group of the trie join holds two of them at most.
CHUNK_SETS = 2048
CHUNK_TOKENS = 500_000
SKETCH = "doc_id bigint, row_key bigint, n bigint, short bigint, sid binary, tokens array<bigint>"


def _sets(column, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text."""
    data, off = tx.utf8(column)
    for i, j in tx.slices(off):
        words, first = tx.hash_words(data[off[i]:off[j]], off[i:j + 1] - off[i])
        h, at = tx.shingles(words, first, k)
        for a, b in zip(at[:-1], at[1:]):
            s = np.sort(h[a:b])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) > 1 else s


def _digest(s: np.ndarray) -> bytes:
    """128 bits that name a set."""
    with np.errstate(over="ignore"):
        one = tx.mix(s + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
        two = tx.mix(s ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return one.tobytes() + two.tobytes()


def prefix(n: int, percent: int) -> int:
    return n + percent * n // -100 + 1  # n - ceil(percent * n / 100) + 1


def _needed(percent: int, slack: int) -> Column:
    """Shared tokens that a set with any partner has in its long prefix."""
    return 1 + F.floor(slack * F.expr(f"({percent} * n + 99) div 100") / 100)


def sketch(docs: DataFrame, k: int, percent: int, slack: int, id: str, text: str) -> DataFrame:
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"),
                       F.xxhash64(F.col(id), F.col(text)).alias("row_key"), F.col(text).cast("string").alias("t"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, short, sid, tokens = [], [], [], []
            for s in _sets(b.column("t"), k):
                n.append(len(s))
                d = _digest(s) if len(s) else None
                sid.append(d)
                short.append(int(np.frombuffer(d, np.int64)[0]) if d else None)
                tokens.append(s[:prefix(len(s), percent) + slack * len(s) // 100].view(np.int64).copy())
            ends = np.concatenate([[0], np.cumsum([len(x) for x in tokens])]).astype(np.int32)
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row_key"), pa.array(n, pa.int64()), pa.array(short, pa.int64()),
                 pa.array(sid, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["doc_id", "row_key", "n", "short", "sid", "tokens"])

    return rows.mapInArrow(run, SKETCH)


def sharing(sets: DataFrame, percent: int, slack: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(short, n) of the sets that may have partners, and (short, token) of
    their prefix tokens that another set has too.

    ``sets`` (short, n, tokens) may hold copies of a set: they have equal
    tokens, so a set of c copies is found c times as often. ``tokens`` is the
    prefix with its ``slack``; without one it is the whole set.
    """
    tokens = sets.select("short", "n", F.posexplode("tokens").alias("pos", "token")).select(
        "short", "token", F.expr(f"pos < n - (({percent} * n + 99) div 100) + 1").alias("inner"))
    sizes = sets.groupBy("short").agg(F.min("n").alias("n"), F.count("*").alias("copies"))
    common = saved(tokens.groupBy("token").agg(F.min("short").alias("a"), F.max("short").alias("b"))
                   .where("a < b").select("token"), "common_tokens")
    held = tokens.join(common, "token")
    least = F.expr(f"({percent} * n + 99) div 100")  # tokens that a set shares with any partner
    if slack is not None:
        least = _needed(percent, slack)
    able = saved(held.groupBy("short").count().join(sizes, "short")
                 .where(F.col("count") >= least * F.col("copies")).select("short", "n"), "able")
    return able, held.where("inner").select("short", "token")


def blocks(able: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """(short, n, block): where the sets meet those that they may be linked with."""
    # Linked sets differ in size by the factor percent/100 at most: their bands are equal or next to each other.
    step = math.log(100 / percent) * 1.0001
    band = F.floor(F.log(F.col("n")) / F.lit(step))
    near = saved(held.join(able, "short").select("short", F.explode(
        F.array(F.xxhash64("token", band), F.xxhash64("token", band + 1))).alias("meeting")), "near")
    least = saved(near.groupBy("meeting").agg(F.min("short").alias("block"), F.max("short").alias("last"))
                  .where("block < last").select("meeting", "block"), "least")
    member = saved(near.join(least, "meeting"), "members")
    for _ in range(ROUNDS):  # any one block for all sets of a group will do: take one that they share with others
        low = saved(member.groupBy("short").agg(F.min("block").alias("low")), "low")
        moved = saved(member.join(low, "short").groupBy("meeting").agg(F.min("low").alias("block")), "moved")
        member = saved(member.drop("block").join(moved, "meeting"), "members")
    return member.select("short", "block").distinct().join(able, "short").select("short", "n", "block")


CELL = "sid binary, links bigint, root binary"


def _cell(percent: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        block, i, j = key[:3]
        pdf = pdf.drop_duplicates("sid").sort_values("sid").reset_index(drop=True)
        sets = [np.asarray(x, np.int64) for x in pdf["tokens"]]
        chunk = pdf["chunk"].to_numpy()
        if len(sets) < 2:
            return pd.DataFrame({"sid": [], "links": [], "root": []})
        stored, probes = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        pairs = similar_pairs(sets, stored, probes, percent)
        if i == j:
            pairs = pairs[pairs[:, 0] < pairs[:, 1]]
        # A pair that meets in several blocks counts in the least of them.
        own = [frozenset(x) for x in pdf["blocks"]]
        pairs = pairs[[min(own[a] & own[b]) == block for a, b in pairs]] if len(pairs) else pairs
        links, copies = np.zeros(len(sets), np.int64), pdf["copies"].to_numpy()
        np.add.at(links, pairs[:, 0], copies[pairs[:, 1]])
        np.add.at(links, pairs[:, 1], copies[pairs[:, 0]])
        root, linked = spanning(len(sets), pairs), np.flatnonzero(links)
        return pd.DataFrame({"sid": pdf["sid"].to_numpy()[linked], "links": links[linked],
                             "root": pdf["sid"].to_numpy()[root[linked]]})

    return run


FULL = "sid binary, short bigint, n bigint, copies bigint, tokens array<bigint>"


def whole_sets(docs: DataFrame, sk: DataFrame, able: DataFrame, k: int, id: str, text: str) -> DataFrame:
    """The sets of ``able``, read whole from one document each (repeated rows repeat them)."""
    sets = saved(sk.select("sid", "short", "doc_id").join(able.select("short"), "short", "left_semi")
                 .groupBy("sid", "short").agg(F.min("doc_id").alias("i"), F.count("*").alias("copies")), "candidates")
    texts = docs.select(F.col(id).cast("bigint").alias("d"), F.col(text).cast("string").alias("t"))
    read = marked(texts, "d", sets.select("i")).join(sets, F.col("d").eqNullSafe(F.col("i"))).select(
        "t", "sid", "short", "copies")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, n, tokens = [], [], []
            for r, (s, sid) in enumerate(zip(_sets(b.column("t"), k), b.column("sid").to_pylist())):
                if len(s) and _digest(s) == sid:  # another text under a repeated id is not the set's
                    rows.append(r)
                    n.append(len(s))
                    tokens.append(s.view(np.int64))
            some = b.select(["sid", "short", "copies"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [some.column("sid"), some.column("short"), pa.array(n, pa.int64()), some.column("copies"),
                 pa.array(tokens, pa.list_(pa.int64()))], names=["sid", "short", "n", "copies", "tokens"])

    return saved(read.mapInArrow(run, FULL), "sets", SMALL_BATCHES)


def trie_links(full: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """(sid, links, root) of the linked sets; several rows a set."""
    size = saved(met.groupBy("block").agg(F.count("*").alias("m"), F.sum("n").alias("w")).select(
        "block", F.greatest(F.ceil(F.col("m") / CHUNK_SETS), F.ceil(F.col("w") / CHUNK_TOKENS)).cast("int").alias("c")), "block_sizes")
    place = met.join(size, "block").select(
        "short", "block", "c", F.expr("cast(pmod(xxhash64(short, block), c) as int)").alias("chunk"))
    cells = (place.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
             .select("short", "block", "chunk", F.least("chunk", "o").alias("i"), F.greatest("chunk", "o").alias("j"))
             .distinct())
    all_blocks = met.groupBy("short").agg(F.collect_set("block").alias("blocks"))
    # A group's work does not show in its bytes: keep Spark from packing groups into few tasks by size.
    parts = int(full.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (full.select("sid", "short", "copies", "tokens").join(all_blocks, "short").join(cells, "short")
            .repartition(parts, "block", "i", "j").groupBy("block", "i", "j").applyInPandas(_cell(percent), CELL))


def join(docs: DataFrame, k: int = 4, percent: int = 85, id: str = "doc_id", text: str = "text",
         slack: int = SLACK) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id, n_links, sid of every document.

    ``row_key`` is a hash of id and text, ``sid`` names the set (null if empty).
    """
    sk = saved(sketch(docs, k, percent, slack, id, text), "sketch", SMALL_BATCHES)
    able, _ = sharing(sk.where("n > 0").select("short", "n", "tokens"), percent, slack)
    full = whole_sets(docs, sk, able, k, id, text)
    able, held = sharing(full.select("short", "n", "tokens"), percent)
    met = saved(blocks(able, held, percent), "blocks")
    linked = saved(trie_links(full, met, percent), "links")
    roots = components(linked.select(F.col("sid").alias("u"), F.col("root").alias("v")))
    sets = sk.where("n > 0").groupBy("sid").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"))
    links = linked.groupBy("sid").agg(F.sum("links").alias("links"))
    known = saved(sets.join(links, "sid", "left").join(roots.withColumnRenamed("node", "sid"), "sid", "left").select(
        "sid", "least", F.coalesce("root", "sid").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "sets_linked")
    ids = saved(known.groupBy("root").agg(F.min("least").alias("component_id")), "component_ids")
    per_set = saved(known.join(ids, "root").select("sid", "component_id", "n_links"), "per_set")
    out = sk.select("doc_id", "row_key", "n", "sid").join(per_set, "sid", "left")
    return out.select("doc_id", "row_key", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "sid")


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with the least id.

    Documents without words, or without an id and a link, are all kept. Of rows
    that repeat id and text one stays.
    """
    found = saved(join(docs, k, percent, id, text), "joined")
    alone = F.col("component_id").isNull() | (F.col("n_shingles") == 0)
    first = found.where(alone | (F.col("component_id") == F.col("doc_id")))
    chosen = first.groupBy("doc_id", "row_key").agg(F.count("*").alias("m"), F.max(F.col("n_shingles") > 0).alias("w"),
                                                    F.min(F.struct("sid")).alias("s"))
    key = fresh(docs, "kept")
    kept = saved(chosen.select(F.struct(F.col("doc_id").alias("d"), F.col("row_key").alias("k"),
                                        (F.col("w") & (F.col("m") > 1)).alias("again")).alias(key)), "kept")
    of = F.col(key)
    rows = docs.join(kept, F.col(id).cast("bigint").eqNullSafe(of["d"]) & (F.xxhash64(F.col(id), F.col(text)) == of["k"]))
    return (rows.where(~of["again"]).select(*docs.columns)
            .union(rows.where(of["again"]).dropDuplicates([key]).select(*docs.columns)))

"""Operator 3: benchmark decontamination by greedy string tiling.

Words (runs of Unicode letters, marks and digits, lower-cased; in scripts
without spaces, such as Chinese, Japanese and Thai, each letter) of documents
and test items are fingerprinted in windows of ``k`` words with a running
Karp-Rabin hash. A bit map of fixed size, made from the items' fingerprints,
thins out the documents' windows; what it lets through joins the items on
fingerprint and words. These equal windows are the seeds of a document and an
item; runs of seeds on one diagonal are matches of more than ``k`` words. The
longest match is marked again and again, cut where words are already marked,
until none of ``k`` words is left. The marked share of the item's words is its
coverage, whatever the order of the tiles, so reordered passages count.

Defined results
---------------
* items of fewer than ``k`` words match nothing, or with ``short`` (as in the
  query and the pipeline) every document that holds their whole sequence.
* null or empty texts match nothing; empty tables give an empty result.
* repeated rows of documents count once; repeated items once per item id and text.
* null doc_id or item_id: carried as null; rows are told apart by their text too.
* very long texts are read whole, in one piece of memory each.
* ties between matches: the earlier place in the item, then in the document.
* a long document that repeats an item: all its seeds take part, the tiles
  cover each word of the item once.
* extra columns are not carried.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .store import SMALL_BATCHES, fresh, saved
from .text import constants

K = 5
COVERAGE = 0.5
#: Bits of the fixed-size map of test-set fingerprints that thins out the documents' windows (4 MB).
MAP_BITS = 1 << 25

_APART = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: How the names of letters of scripts without spaces begin.
_UNSPACED = ("CJK UNIFIED IDEOGRAPH", "CJK COMPATIBILITY IDEOGRAPH", "IDEOGRAPHIC ", "VERTICAL IDEOGRAPHIC ", "HANGZHOU ",
             "HIRAGANA ", "KATAKANA", "HALFWIDTH KATAKANA", "THAI ", "LAO ", "KHMER ", "MYANMAR ")
APART, LETTER, UNSPACED, MARK, UNKNOWN = range(5)
_CLASS = np.full(0x110000, UNKNOWN, np.uint8)
_ROLL = constants(1, 31)[0]
_BACK = np.uint64(pow(int(_ROLL), -1, 1 << 64))


def _class(c: str) -> int:
    kind = unicodedata.category(c)[0]
    if ord(c) < 128:
        return LETTER if c.isalnum() else APART
    if kind == "M":
        return MARK
    if kind not in "LN":
        return APART
    return UNSPACED if unicodedata.name(c, "").startswith(_UNSPACED) else LETTER


def classes(cp: np.ndarray) -> np.ndarray:
    """The class of each code point; the table is filled as code points are met."""
    out = _CLASS[cp]
    if (out == UNKNOWN).any():
        for c in np.unique(cp[out == UNKNOWN]):
            _CLASS[c] = _class(chr(c))
        out = _CLASS[cp]
    return out


class Words:
    """The words of some texts: ``hashes``, and ``first``, the first word of each text with their total."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        if not len(data) or data.max() < 128:
            self.points = data
            self.starts, self.ends, _ = tx.word_spans(data, off, _APART)
            self.hashes, self.first = tx.hash_words(data, off, apart=_APART)
            return
        raw = data.tobytes()
        low = [raw[a:b].decode("utf-8", "replace").lower() for a, b in zip(off[:-1], off[1:])]
        cp = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        at = np.concatenate([[0], np.cumsum([len(t) for t in low])])
        kind = classes(cp)
        apart = kind == APART
        before = np.concatenate([[True], apart[:-1]])      # nothing or no word's character before it
        before[at[at < len(cp)]] = True
        base = np.maximum.accumulate(np.where(kind != MARK, np.arange(len(cp)), 0))
        own = np.concatenate([[False], kind[base[:-1]] == UNSPACED])  # an unspaced letter, with its marks, before it
        begin = ~apart & (before | (kind == UNSPACED) | ((kind == LETTER) & own))
        self.points, self.starts = cp, np.flatnonzero(begin)
        self.first = np.searchsorted(self.starts, at)
        if not len(self.starts):
            self.ends, self.hashes = self.starts, np.zeros(0, np.uint64)
            return
        lens = np.diff(np.append(self.starts, len(cp)))
        size = np.add.reduceat((~apart).astype(np.int64), self.starts)
        self.ends = self.starts + size
        self.hashes = tx.hash_points(np.where(apart, 0, cp), apart, self.starts, lens, size)

    def windows(self, m: int) -> np.ndarray:
        """Karp-Rabin fingerprints of all runs of ``m`` words, each rolled on from the one before: with C the running
        sum of w[i] / B**i, the window at i is (C[i + m] - C[i]) * B**i."""
        n = len(self.hashes)
        if n < m:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            up = np.full(n, _ROLL, np.uint64)
            down = np.full(n, _BACK, np.uint64)
            up[0] = down[0] = 1
            up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
            run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * down, dtype=np.uint64)])
            return tx.mix((run[m:] - run[:-m]) * up[:n - m + 1] + np.uint64(m))

    def text(self, i: int, m: int) -> str:
        """The ``m`` words from word ``i``, lower-cased, one blank between them."""
        cut = [self.points[a:b] for a, b in zip(self.starts[i:i + m], self.ends[i:i + m])]
        if self.points.dtype == np.uint8:
            return " ".join(c.tobytes().decode("ascii").lower() for c in cut)
        return " ".join(c.tobytes().decode("utf-32-le", "surrogatepass") for c in cut)


SEEDS = "doc_id bigint, row_key bigint, n bigint, seed bigint, pos int, words string"


def seeds(rows: DataFrame, k: int, only=None, sizes: Iterable[int] = (), whole: bool = False) -> DataFrame:
    """Fingerprints of rows (doc_id, row_key, t) with their places and words; ``only``, a broadcast bit map of
    fingerprints, keeps those whose bit is set.

    Windows have k words and those of ``sizes``; with ``whole`` a text of fewer words than k is one window.
    """
    sizes = [*(range(1, k) if whole else sizes), k]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = tx.utf8(b.column("t"))
            for i, j in tx.slices(off):
                w = Words(data[off[i]:off[j]], off[i:j + 1] - off[i])
                count = np.diff(w.first)
                own = np.repeat(np.arange(j - i), count)
                r, h, p, t = [], [], [], []
                for m in sizes:
                    f = w.windows(m)
                    at = np.arange(len(f))
                    inside = at + m <= w.first[1:][own[:len(f)]]
                    if whole and m < k:
                        inside &= count[own[:len(f)]] == m
                    if only is not None:
                        bit = f & np.uint64(MAP_BITS - 1)
                        inside &= (only.value[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    at = at[inside]
                    r.append(own[at])
                    h.append(f[at].view(np.int64))
                    p.append(at - w.first[own[at]])
                    t += [w.text(x, m) for x in at]
                if t:
                    r = np.concatenate(r)
                    some = b.slice(i, j - i).select(["doc_id", "row_key"]).take(pa.array(r))
                    yield pa.RecordBatch.from_arrays(
                        [*some.columns, pa.array(count[r]), pa.array(np.concatenate(h)),
                         pa.array(np.concatenate(p).astype(np.int32)), pa.array(t, pa.string())],
                        names=["doc_id", "row_key", "n", "seed", "pos", "words"])

    return rows.mapInArrow(run, SEEDS)


def seed_map(tests: DataFrame):
    """A broadcast bit map of the fingerprints in ``tests``: MAP_BITS / 8 bytes, however many there are."""
    bit = tests.select((F.col("seed").bitwiseAND(F.lit(MAP_BITS - 1)) + 1).alias("bit"))  # Spark counts bits from 1
    maps = bit.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    out = np.zeros(MAP_BITS // 8, np.uint8)
    for r in maps.collect():  # at most MAP_BITS bits
        own = np.frombuffer(bytes(r["map"]), np.uint8)
        at = (r["bucket"] - 1) * len(own)
        out[at:at + len(own)] |= own
    return tests.sparkSession.sparkContext.broadcast(out)


def tiles(dpos: np.ndarray, ipos: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from the seeds (document place, item place): (item place, document place, length)."""
    order = np.lexsort((ipos, dpos - ipos))
    d, i = dpos[order], ipos[order]
    edge = np.flatnonzero(np.concatenate([[True], (np.diff(d - i) != 0) | (np.diff(i) != 1)]))
    lens = np.diff(np.append(edge, len(d))) + k - 1
    waiting = [(-int(n), int(i[e]), int(d[e])) for n, e in zip(lens, edge)]
    heapq.heapify(waiting)
    used_i = np.zeros(int(i.max()) + int(lens.max()) + 1, bool)
    used_d: set[int] = set()
    out = []
    while waiting:
        n, a, b = heapq.heappop(waiting)
        n = -n
        free = np.array([not used_i[a + x] and (b + x) not in used_d for x in range(n)])
        if free.all():
            used_i[a:a + n] = True
            used_d.update(range(b, b + n))
            out.append((a, b, n))
            continue
        step = np.diff(np.concatenate([[0], free.astype(np.int8), [0]]))
        for s, e in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)):
            if e - s >= k:
                heapq.heappush(waiting, (-int(e - s), a + int(s), b + int(s)))
    return out


OUT = "doc_id bigint, row_key bigint, item_id bigint, item_words bigint, matched_words bigint, n_tiles int, coverage double"


def _cover(k: int, least: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["pos", "item_pos"])
        total = int(pdf["item_words"].iloc[0])
        found = tiles(pdf["pos"].to_numpy(np.int64), pdf["item_pos"].to_numpy(np.int64), min(k, total))
        n = sum(t[2] for t in found)
        if n < least * total:
            return pd.DataFrame(columns=["doc_id", "row_key", "item_id", "item_words", "matched_words", "n_tiles", "coverage"])
        return pd.DataFrame({"doc_id": [pdf["doc_id"].iloc[0]], "row_key": [key[0]], "item_id": [pdf["item_id"].iloc[0]],
                             "item_words": [total], "matched_words": [n], "n_tiles": [len(found)],
                             "coverage": [n / total]}).astype({"doc_id": "Int64", "item_id": "Int64"})

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = K, coverage: float = COVERAGE, id: str = "doc_id",
                 text: str = "text", item: str = "item_id", item_text: str = "text", short: bool = False) -> DataFrame:
    """One row for each document and test item covered to ``coverage`` or more."""
    def rows(df: DataFrame, i: str, t: str) -> DataFrame:
        return df.select(F.col(i).cast("bigint").alias("doc_id"), F.xxhash64(F.col(i), F.col(t)).alias("row_key"),
                         F.col(t).cast("string").alias("t")).where("t is not null")

    tests = saved(seeds(rows(benchmark, item, item_text), k, whole=short).distinct(), "test_seeds")
    sizes = sorted(r.n for r in tests.where(F.col("n") < k).select("n").distinct().collect())  # fewer than k values
    found = saved(seeds(rows(docs, id, text), k, seed_map(tests), sizes).drop("n").distinct(), "seeds", SMALL_BATCHES)
    tests = tests.select(F.col("doc_id").alias("item_id"), F.col("row_key").alias("item_key"),
                         F.col("n").alias("item_words"), "seed", "words", F.col("pos").alias("item_pos"))
    # Equal fingerprints count only where the words are equal too.
    pairs = found.join(tests, ["seed", "words"]).drop("seed", "words")
    # Marked words are at most k per matching item place: pairs with too few places cannot reach the coverage.
    able = saved(pairs.groupBy("row_key", "item_key", "item_words").agg(F.countDistinct("item_pos").alias("places"))
                 .where(F.col("places") * k >= F.col("item_words") * coverage).select("row_key", "item_key"), "able")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # work, not bytes, is to be dealt out
    hit = pairs.join(able, ["row_key", "item_key"], "left_semi").repartition(parts, "row_key", "item_key")
    return hit.groupBy("row_key", "item_key").applyInPandas(_cover(k, coverage), OUT)


def decontaminate(docs: DataFrame, benchmark: DataFrame, k: int = K, coverage: float = COVERAGE, id: str = "doc_id",
                  text: str = "text", short: bool = False) -> DataFrame:
    """``docs`` without the documents that cover a test item."""
    key = fresh(docs, "row_key")
    bad = contaminated(docs, benchmark, k, coverage, id, text, short=short).select(F.col("row_key").alias(key)).distinct()
    own = docs.withColumn(key, F.xxhash64(F.col(id), F.col(text)))
    return own.join(saved(bad, "contaminated"), key, "left_anti").select(*docs.columns)

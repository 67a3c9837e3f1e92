"""Operator 11: repeated lines dropped by probing a sharded minimal perfect hash.

A line is known by the 128-bit digest of its key: the line without white space
at its ends, A-Z lower-cased. One scan counts the documents of every distinct
digest, added up inside the tasks before the shuffle. The digests found in
``least`` documents or more are dealt to shards by their first half, and each
shard is made into a minimal perfect hash: levels of bits in which a digest
that meets no other has its bit set, and the rank of that bit is its slot.
Slots hold a fingerprint (the second half of the digest) and the count.
Digests that are not indexed are turned away by the fingerprint: to be taken
for another, a line must agree with it in 64 bits and fall on its slot.

A second scan probes the arrays for every line and joins no lines. Arrays of
up to ``BROADCAST`` bytes are sent to all tasks. Larger ones stay where they
are: the documents' distinct digests go to the shards and probe the arrays
there. The counts tell how many digests a shard will see, so a shard with hot
lines is copied to as many groups as it needs, and the digests are dealt over
the copies. Results are the same.

Defined results
---------------
* null and empty texts have one empty line, which is never dropped.
* every row is a document: repeated rows count, and are returned, each.
* a line repeated within a document counts once for it and loses all its places.
* very long texts and lines: read whole; memory follows the longest text.
* ties: none; a line goes or stays by its count alone.
* null ids are carried; an empty table gives an empty result.
* extra columns are not carried, so no name can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .store import saved
from .text import constants, mix, slices, utf8

#: Digests a shard holds, about.
SHARD = 1 << 16
#: Bits of a level for each digest that is left.
ROOM = 2
#: Bytes of arrays that are sent to all tasks; larger indexes are probed shard by shard.
BROADCAST = 32 << 20
#: Digests that a group of probes holds, about.
PROBES = 1 << 20
#: Distinct lines a task holds before it passes their counts on, and bytes of text it probes at once.
HELD, HELD_BYTES = 1 << 18, 1 << 22

_ENDS = b" \t\n\x0b\x0c\r"
_SEED = constants(64, 7)
_TIMES = constants(2, 8)


def key(line: bytes) -> bytes:
    return line.strip(_ENDS).lower()  # of bytes: A-Z only


def _long_enough(k: bytes, chars: int) -> bool:
    if len(k) < chars or chars <= 1:
        return len(k) >= chars
    return len(k) - sum(0x80 <= c < 0xC0 for c in k) >= chars


def line_digests(lines: list[bytes], chars: int) -> list[bytes | None]:
    """The digest of each line's key, None where it has fewer than ``chars`` code points."""
    digest = xxhash.xxh3_128_digest
    return [digest(k) if _long_enough(k, chars) else None for k in map(key, lines)]


def _texts(column) -> Iterator[bytes]:
    for t in column.cast(pa.binary()):
        yield t.as_py() or b""


def _halves(digests: Iterable[bytes]) -> np.ndarray:
    """(n, 2) unsigned 64-bit halves."""
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2).astype(np.uint64)


def line_counts(docs: DataFrame, text: str = "text", chars: int = 1) -> DataFrame:
    """(a, b, n): the halves of every distinct digest and the number of its documents."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for b in batches:
            for t in _texts(b.column(0)):
                for d in set(line_digests(t.split(b"\n"), chars)):
                    if d is not None:
                        held[d] = held.get(d, 0) + 1
                if len(held) >= HELD:
                    yield _counted(held)
                    held = {}
        if held:
            yield _counted(held)

    part = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "a bigint, b bigint, n bigint")
    return part.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _counted(held: dict[bytes, int]) -> pa.RecordBatch:
    h = _halves(held).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(list(held.values()), pa.int64())],
                                      names=["a", "b", "n"])


def shard_of(a: np.ndarray, shards: int) -> np.ndarray:
    return (mix(a ^ _SEED[-1]) % np.uint64(shards)).astype(np.int64)


def _place(h: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = mix(h[:, 0] * _TIMES[0] + h[:, 1] * _TIMES[1] + np.uint64(level) * _SEED[level % 63])
    return (x % np.uint64(bits)).astype(np.int64)


class Shard:
    """A minimal perfect hash of distinct digests with their fingerprints and counts."""

    def __init__(self, sizes: Iterable[int], bits: bytes, prints: bytes, counts: bytes):
        self.sizes = [int(s) for s in sizes]
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8))[:sum(self.sizes)].astype(bool)
        self.rank = np.concatenate([[0], np.cumsum(self.bits, dtype=np.int32)])
        self.prints, self.counts = np.frombuffer(prints, "<u8"), np.frombuffer(counts, "<u4")

    @staticmethod
    def build(h: np.ndarray, n: np.ndarray) -> tuple[list[int], bytes, bytes, bytes]:
        """(level sizes, bits, fingerprints, counts) for distinct digests."""
        sizes, parts, slot_of, left, at = [], [], np.zeros(len(h), np.int64), np.arange(len(h)), 0
        while len(left):
            size = ROOM * len(left)
            place = _place(h[left], len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            done = alone[place]
            slot_of[left[done]] = at + place[done]
            sizes.append(size)
            parts.append(alone)
            at, left = at + size, left[~done]
        order = np.argsort(slot_of, kind="stable")
        bits = np.packbits(np.concatenate(parts)).tobytes() if parts else b""
        counts = np.minimum(n[order], 0xFFFFFFFF).astype("<u4")
        return sizes, bits, h[order, 1].astype("<u8").tobytes(), counts.tobytes()

    def count(self, h: np.ndarray) -> np.ndarray:
        """The count of each digest, 0 for those not indexed."""
        out, left, base = np.zeros(len(h), np.int64), np.arange(len(h)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            place = base + _place(h[left], level, size)
            hit = self.bits[place]
            slot = self.rank[place[hit]]
            same = self.prints[slot] == h[left[hit], 1]
            out[left[hit][same]] = self.counts[slot[same]]
            left, base = left[~hit], base + size
        return out


ARRAYS = "shard int, n bigint, documents bigint, sizes array<int>, bits binary, prints binary, counts binary"


def build_index(counts: DataFrame, least: int) -> tuple[DataFrame, int, int]:
    """(one row of arrays a shard, number of shards, documents of all digests added up) for the digests
    of ``least`` documents or more."""
    seen = Observation()
    wanted = saved(counts.observe(seen, F.sum("n").alias("total")).where(F.col("n") >= least), "lines")
    shards = max(1, -(-wanted.count() // SHARD))

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a = b.column("a").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard_of(a, shards).astype(np.int32))],
                                             names=["a", "b", "n", "shard"])

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        h = pdf[["a", "b"]].to_numpy(np.int64).view(np.uint64)
        sizes, bits, prints, n = Shard.build(h, pdf["n"].to_numpy(np.int64))
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "n": [len(pdf)], "documents": [int(pdf["n"].sum())],
                             "sizes": [sizes], "bits": [bits], "prints": [prints], "counts": [n]})

    numbered = wanted.mapInArrow(number, "a bigint, b bigint, n bigint, shard int")
    return saved(numbered.groupBy("shard").applyInPandas(build, ARRAYS), "line_index"), shards, seen.get["total"] or 0


class Index:
    """The shards that a task holds."""

    def __init__(self, rows: Iterable, shards: int):
        self.shards = shards
        self.rows = {r["shard"]: (r["sizes"], bytes(r["bits"]), bytes(r["prints"]), bytes(r["counts"])) for r in rows}
        self.open: dict[int, Shard] = {}

    def count(self, h: np.ndarray) -> np.ndarray:
        out, of = np.zeros(len(h), np.int64), shard_of(h[:, 0], self.shards)
        order = np.argsort(of, kind="stable")
        edge = np.flatnonzero(np.diff(of[order], prepend=-1, append=self.shards))
        for s, e in zip(edge[:-1], edge[1:]):
            shard = int(of[order[s]])
            if shard in self.rows:
                if shard not in self.open:
                    self.open[shard] = Shard(*self.rows[shard])
                out[order[s:e]] = self.open[shard].count(h[order[s:e]])
        return out


def _kept(t: bytes, drop) -> tuple[int, int, bytes]:
    """(lines, lines dropped, the rest joined): ``drop`` says it of each line's number."""
    lines = t.split(b"\n")
    rest = [x for i, x in enumerate(lines) if not drop(i)]
    return len(lines), len(lines) - len(rest), b"\n".join(rest)


OUT = "doc_id bigint, n_lines bigint, n_dropped bigint, kept string"


def _out(ids: pa.Array, done: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
         pa.array([d[2] for d in done], pa.binary()).cast(pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept"])


def _probe_here(rows: DataFrame, arrays: DataFrame, shards: int, min_docs: int, chars: int) -> DataFrame:
    index = rows.sparkSession.sparkContext.broadcast(Index(arrays.collect(), shards))  # at most BROADCAST bytes

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off = utf8(b.column("t"))[1]
            for i, j in slices(off, HELD_BYTES):
                some = b.slice(i, j - i)
                texts = list(_texts(some.column("t")))
                digests = [line_digests(t.split(b"\n"), chars) for t in texts]
                known = list({d for own in digests for d in own if d is not None})
                n = index.value.count(_halves(known)) if known else []
                gone = {d for d, x in zip(known, n) if x >= min_docs}
                yield _out(some.column("doc_id"), [_kept(t, lambda x, own=own: own[x] in gone) for t, own in zip(texts, digests)])

    return rows.mapInArrow(run, OUT)


def _probe_there(rows: DataFrame, arrays: DataFrame, shards: int, total: int, min_docs: int, chars: int,
                 probes: int) -> DataFrame:
    """Digests go to the shards' arrays; only the lines to drop come back to the documents."""
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")  # written, so the numbers stay

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, t in zip(b.column("row").to_pylist(), _texts(b.column("t"))):
                places: dict[bytes, list[int]] = {}
                for i, d in enumerate(line_digests(t.split(b"\n"), chars)):
                    if d is not None:
                        places.setdefault(d, []).append(i)
                if places:
                    h, n = _halves(places), len(places)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * n, pa.int64()), pa.array(h[:, 0].view(np.int64)), pa.array(h[:, 1].view(np.int64)),
                         pa.array(shard_of(h[:, 0], shards).astype(np.int32)), pa.array(list(places.values()), pa.list_(pa.int32()))],
                        names=["row", "a", "b", "shard", "lines"])

    asked = rows.select("row", "t").mapInArrow(run, "row bigint, a bigint, b bigint, shard int, lines array<int>")
    others = total / shards  # digests that are not indexed meet the shards evenly
    copies = arrays.select("shard", F.ceil((F.col("documents") + F.lit(others)) / F.lit(float(probes))).cast("int").alias("copies"))
    asked = asked.join(copies, "shard").withColumn("copy", F.pmod(F.xxhash64("row"), F.col("copies")).cast("int"))
    spread = arrays.join(copies, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"row": pd.Series(dtype="int64"), "lines": pd.Series(dtype="object")})
        r = right.iloc[0]
        n = Shard(r["sizes"], r["bits"], r["prints"], r["counts"]).count(left[["a", "b"]].to_numpy(np.int64).view(np.uint64))
        return left.loc[n >= min_docs, ["row", "lines"]]

    hits = (asked.groupBy("shard", "copy").cogroup(spread.groupBy("shard", "copy"))
            .applyInPandas(probe, "row bigint, lines array<int>"))
    gone = saved(hits, "line_hits").groupBy("row").agg(F.flatten(F.collect_list("lines")).alias("lines"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = [set(x or ()) for x in b.column("lines").to_pylist()]
            yield _out(b.column("doc_id"), [_kept(t, m.__contains__) for t, m in zip(_texts(b.column("t")), marks)])

    return rows.join(gone, "row", "left").select("doc_id", "t", "lines").mapInArrow(cut, OUT)


def drop_lines(docs: DataFrame, min_docs: int = 10, chars: int = 1, id: str = "doc_id", text: str = "text",
               broadcast: int = BROADCAST, probes: int = PROBES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): every document without the lines that ``min_docs`` documents share."""
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("t"))
    arrays, shards, total = build_index(line_counts(rows, "t", chars), min_docs)
    size = arrays.agg(F.sum(F.octet_length("bits") + F.octet_length("prints") + F.octet_length("counts"))).first()[0] or 0
    if size <= broadcast:
        return _probe_here(rows, arrays, shards, min_docs, chars)
    return _probe_there(rows, arrays, shards, total, min_docs, chars, probes)


def digests(docs: DataFrame, **options) -> DataFrame:
    """``drop_lines`` with the digest of the kept text in its place."""
    done = drop_lines(docs, **options)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))

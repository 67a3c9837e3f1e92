"""Operator 11 against plain Python, and its perfect hash."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from adlens.llm import line_index as li

from .cases import empty, frame, rows

WS = " \t\n\x0b\x0c\r"


def plain(texts, least, chars=1):
    def key(x):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(WS))

    split = [(t or "").split("\n") for t in texts]
    seen = Counter(k for own in split for k in {key(x) for x in own})
    out = []
    for own in split:
        rest = [x for x in own if not (len(key(x)) >= chars and seen[key(x)] >= least)]
        out.append((len(own), len(own) - len(rest), "\n".join(rest)))
    return out


def some_texts():
    rnd = random.Random(3)
    pool = ["Share this", " share THIS\t", "É", "é", "", "  ", "all rights reserved", "a", "日本"] + [f"line {i}" for i in range(30)]
    return [None, "", "\n", "Share this", "Share this\nshare this\n\nown"] + [
        "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 12))) for _ in range(60)]


@pytest.mark.parametrize("broadcast, probes", [(1 << 20, 1 << 20), (0, 1 << 20), (0, 3)])
def test_equals_plain_python_by_either_way(spark, broadcast, probes):
    texts = some_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for least, chars in ((10, 1), (3, 2)):
        got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept)
               for r in li.drop_lines(df, least, chars, broadcast=broadcast, probes=probes).collect()}
        assert got == dict(enumerate(plain(texts, least, chars)))


def test_every_digest_has_its_own_slot():
    rnd = np.random.default_rng(1)
    h = rnd.integers(0, 1 << 63, (20_000, 2)).astype(np.uint64)
    n = rnd.integers(1, 1 << 40, len(h))
    sizes, bits, prints, counts = li.Shard.build(h, n)
    shard = li.Shard(sizes, bits, prints, counts)
    assert len(shard.prints) == len(h) == shard.bits.sum()             # minimal
    assert (shard.count(h) == np.minimum(n, 0xFFFFFFFF)).all()          # perfect
    other = rnd.integers(0, 1 << 63, (20_000, 2)).astype(np.uint64)
    assert not shard.count(other).any()                                 # others are turned away
    assert len(bits) * 8 < 5 * len(h)
    same_half = np.stack([np.full(50, 7, np.uint64), np.arange(50, dtype=np.uint64)], axis=1)
    assert (li.Shard(*li.Shard.build(same_half, np.arange(50))).count(same_half) == np.arange(50)).all()
    assert li.Shard.build(h[:0], n[:0])[0] == []


def test_many_shards_hold_every_digest_once(spark, monkeypatch):
    df = spark.range(5000).selectExpr("id AS a", "id * 7 AS b", "id % 9 AS n")
    monkeypatch.setattr(li, "SHARD", 100)
    arrays, shards, total = li.build_index(df, 3)
    rows_ = arrays.collect()
    want = {(i, i * 7): i % 9 for i in range(5000)}
    assert total == sum(want.values()) and shards == -(-sum(v >= 3 for v in want.values()) // 100)
    assert max(r.n for r in rows_) < 200
    index = li.Index(rows_, shards)
    got = index.count(np.array(list(want), np.uint64))
    assert got.tolist() == [v if v >= 3 else 0 for v in want.values()]


def test_a_hot_line_is_dealt_over_copies(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "concat('hot line\\nown ', id) AS text").repartition(6)
    out = li.drop_lines(df, 10, broadcast=0, probes=100)
    assert {(r.n_lines, r.n_dropped, r.kept == f"own {r.doc_id}") for r in out.collect()} == {(2, 1, True)}


def test_awkward(spark):
    df = frame(spark)
    texts = [r[1] for r in rows()]
    want = sorted(((r[0], *p) for r, p in zip(rows(), plain(texts, 2))), key=str)
    for broadcast in (1 << 20, 0):
        got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in li.drop_lines(df, 2, broadcast=broadcast).collect()), key=str)
        assert got == want
        assert li.drop_lines(empty(spark), broadcast=broadcast).count() == 0
    one = li.digests(df.where("doc_id = 7"), min_docs=2).first()
    assert one.kept_sha256 == hashlib.sha256(rows()[7][1].encode()).hexdigest()
    assert li.digests(df, min_docs=2).columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]

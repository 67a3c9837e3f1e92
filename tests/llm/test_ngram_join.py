"""Operator 1 against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from adlens.llm import ngram_join, trie
from adlens.llm.graph import components

from .cases import empty, frame, rows


def brute(items, k, percent):
    """{(id, text): (size, component, links)} by comparing all pairs of rows."""
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()
    sets = [shingles(t) for _, t in items]
    up = list(range(len(items)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    links = [0] * len(items)
    for a in range(len(items)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                up[root(a)] = root(b)
    out = []
    for x, (i, t) in enumerate(items):
        ids = [items[y][0] for y in range(len(items)) if root(y) == root(x) and items[y][0] is not None]
        out.append((i, len(sets[x]), min(ids) if sets[x] and ids else i, links[x]))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in df.collect()), key=str)


def family(seed, n, changes):
    rnd = random.Random(seed)
    base = [f"b{seed}x{i}" for i in range(80)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, changes)):
            w[rnd.randrange(len(w))] = f"u{rnd.random()}"
        out.append(" ".join(w[rnd.randint(0, 3):]))
    return out


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
def test_equals_brute_force(spark, k, percent):
    texts = family(1, 30, 4) + family(2, 8, 2) + family(3, 1, 0) * 5
    # a passage that many otherwise different documents share
    shared = " ".join(f"p{i}" for i in range(40))
    texts += [shared + " " + " ".join(f"q{j}y{i}" for i in range(j)) for j in range(0, 60, 4)]
    items = [(100 - n, t) for n, t in enumerate(texts)]
    df = spark.createDataFrame(items, "doc_id long, text string")
    assert found(ngram_join.join(df, k, percent)) == brute(items, k, percent)


def test_blocks_cut_into_chunks_find_the_same(spark, monkeypatch):
    items = list(enumerate(family(4, 40, 4)))
    monkeypatch.setattr(ngram_join, "CHUNK_SETS", 7)
    df = spark.createDataFrame(items, "doc_id long, text string")
    assert found(ngram_join.join(df, 4, 85)) == brute(items, 4, 85)


def test_awkward_rows(spark):
    want = brute([(r[0], r[1]) for r in rows()], 4, 85)
    assert found(ngram_join.join(frame(spark), 4, 85)) == want
    assert ngram_join.join(empty(spark)).count() == 0


def test_keep_one_of_each_group(spark):
    kept = ngram_join.keep_one(frame(spark))
    assert kept.columns == frame(spark).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    # 2 and 8 are copies of 1, one of the repeated rows 6 stays; texts without words are all kept
    assert ids == sorted([1, 3, 4, 5, 6, 7, 9, 10, 11, None, None], key=str)
    assert ngram_join.keep_one(empty(spark)).count() == 0


def test_trie_finds_all_pairs():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(60)]
    every = np.arange(len(sets))
    got = set(map(tuple, trie.similar_pairs(sets, every, every, 70).tolist()))
    want = {(a, b) for a in every for b in every if a != b and
            100 * len(np.intersect1d(sets[a], sets[b])) >= 70 * len(np.union1d(sets[a], sets[b]))}
    assert got == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "u long, v long")
    got = dict(map(tuple, components(edges).collect()))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}

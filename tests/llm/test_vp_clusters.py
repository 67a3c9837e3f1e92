"""Operator 12 against plain Python integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.errors import PythonException

from adlens.llm import vp_clusters as vp


def nearest(v, points):
    return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))


def plain(data, k, rounds, dim, scale):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in data
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    points = [v for _, v in order[:k]]
    for _ in range(rounds):
        own = [nearest(v, points)[1] for _, v in kept]
        for c in range(len(points)):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            if mine:
                points[c] = [sum(col) // len(mine) for col in zip(*mine)]
    found = [(i, *nearest(v, points)[::-1]) for i, v in kept]
    by = {}
    for _, c, d in found:
        by[c] = by.get(c, 0) + d
    return sorted(((i, c, d, by[c], sum(by.values()), hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest())
                   for i, c, d in found), key=str)


def run(spark, data, **kw):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in data], "vec_id long, embedding array<double>, cluster string, i int")
    return sorted((tuple(r) for r in vp.cluster(df.repartition(3), **kw).collect()), key=str)


@pytest.mark.parametrize("seed, spread", [(0, 3.0), (1, 0.05), (2, 100.0)])
def test_equals_plain_python(spark, seed, spread):
    rnd = np.random.default_rng(seed)
    data = [(n, [float(x) for x in rnd.normal(0, spread, 6)]) for n in range(250)]
    data += [(300, [0.0] * 6)] * 40                                   # one vector many times
    assert run(spark, data, k=12, rounds=3, dim=6, scale=4.0) == plain(data, 12, 3, 6, 4.0)


def test_awkward_vectors(spark):
    good = [(n, [n / 10, -n / 7, 0.3]) for n in range(8)]
    odd = [(20, None), (21, []), (22, [1.0, 2.0]), (23, [1.0, None, 2.0]), (24, [1.0, float("nan"), 2.0]),
           (25, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (3, good[3][1]), (3, good[3][1]), (None, None)]
    data = good + odd
    for k in (1, 3, 50):
        assert run(spark, data, k=k, rounds=2, dim=3) == plain(data, k, 2, 3, 64.0)
    none = run(spark, odd[:6], k=4, dim=3)
    assert none == [] and vp.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    with pytest.raises(PythonException, match="would not fit a long"):
        run(spark, [(1, [1e30, 0.0, 0.0])], k=1, dim=3)


@pytest.mark.parametrize("k, dim, span", [(1, 4, 5), (16, 64, 20), (300, 8, 3), (500, 3, 2), (200, 16, (1 << 27) - 1)])
def test_tree_finds_the_nearest_and_the_smallest_number_of_ties(k, dim, span):
    rnd = np.random.default_rng(k)
    points = rnd.integers(-span, span + 1, (k, dim))
    vectors = np.concatenate([rnd.integers(-span, span + 1, (400, dim)), points])
    far = np.array([((v - points) ** 2).sum(axis=1) for v in vectors])
    own, d = vp.VpTree(points).nearest(vectors)
    assert (own == far.argmin(axis=1)).all() and (d == far.min(axis=1)).all()


def test_search_leaves_nodes_unopened(monkeypatch):
    rnd = np.random.default_rng(4)
    centre = rnd.integers(-1000, 1000, (40, 8))
    points = (centre[:, None, :] + rnd.integers(-5, 6, (40, 10, 8))).reshape(-1, 8)
    seen = []
    real = vp.squared
    monkeypatch.setattr(vp, "squared", lambda a, b: seen.append(len(a)) or real(a, b))
    tree = vp.VpTree(points)
    seen.clear()
    tree.nearest(centre)
    assert sum(seen) < 0.3 * len(points) * len(centre)

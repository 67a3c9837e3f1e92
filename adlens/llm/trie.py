"""Set similarity join of two small lists of sets by a prefix tree.

The sets' tokens are put in one global order (most shared first), the sets of
one side are stored in a path-compressed trie, and all sets of the other side
descend it together. Every node keeps the overlap of its path with each probe,
shared by all sets below it; probes leave a subtree as soon as the overlap so
far plus the remaining length cannot reach the required one.
"""

from __future__ import annotations

import numpy as np


def _shared(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Ranks of the tokens that occur in two sets or more, most frequent first."""
    sizes = [len(s) for s in sets]
    tokens, back, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    rank = np.empty(len(tokens), np.int64)
    rank[order] = np.arange(len(tokens))
    rank[count < 2] = -1
    ends = np.cumsum(sizes)
    out = []
    for e, n in zip(ends, sizes):
        r = rank[back[e - n:e]]
        out.append(np.sort(r[r >= 0]))
    return out


#: Bytes of the table that says which probe holds which token.
TABLE = 1 << 24


def similar_pairs(sets: list[np.ndarray], stored: np.ndarray, probes: np.ndarray, percent: int) -> np.ndarray:
    """Rows (stored set, probe) with 100 * intersection >= percent * union.

    ``stored`` and ``probes`` are indices into ``sets`` (arrays of distinct
    tokens). When both name the same set it is not paired with itself, and a
    pair named in both orders is returned in both. The trie is built once;
    the probes descend it in parties that keep their table small.
    """
    size = np.array([len(s) for s in sets])
    ranks = _shared(sets)
    # Paths in lexicographic order; neighbours' common lengths give the tree.
    order = sorted(stored, key=lambda s: ranks[s].astype(">u4").tobytes())
    paths = [ranks[s] for s in order]
    lens = np.array([len(p) for p in paths])
    full = size[order]
    common = np.zeros(len(paths), np.int64)
    for k in range(1, len(paths)):
        n = min(lens[k - 1], lens[k])
        diff = np.flatnonzero(paths[k - 1][:n] != paths[k][:n])
        common[k] = diff[0] if len(diff) else n
    width = 1 + max((int(r[-1]) for r in ranks if len(r)), default=-1)
    party = max(16, TABLE // max(width, 1))
    out = [_descend(ranks, size, order, paths, lens, full, common, probes[i:i + party], width, percent)
           for i in range(0, len(probes), party)]
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _descend(ranks, size, order, paths, lens, full, common, probes, width: int, percent: int) -> np.ndarray:
    has = np.zeros((width, len(probes)), dtype=np.uint8)
    for j, p in enumerate(probes):
        has[ranks[p], j] = 1
    p_size, p_len = size[probes], np.array([len(ranks[p]) for p in probes])
    found = []
    stack = [(0, len(paths), 0, np.zeros(len(probes), np.int64), np.arange(len(probes)))]
    while stack:
        lo, hi, depth, overlap, alive = stack.pop()
        to = int(common[lo + 1:hi].min()) if hi - lo > 1 else int(lens[lo])
        if to > depth:
            overlap = overlap + has[paths[lo][depth:to]][:, alive].sum(axis=0, dtype=np.int64)
        left = int(lens[lo:hi].max()) - to
        need = -(-percent * (p_size[alive] + int(full[lo:hi].min())) // (100 + percent))
        can = overlap + np.minimum(left, p_len[alive] - overlap) >= need
        if not can.any():
            continue
        overlap, alive = overlap[can], alive[can]
        while lo < hi and lens[lo] == to:  # sets that end here come first
            hit = alive[overlap * (100 + percent) >= percent * (p_size[alive] + full[lo])]
            found += [(order[lo], probes[j]) for j in hit if order[lo] != probes[j]]
            lo += 1
        if lo < hi:
            edges = [lo, *(lo + 1 + np.flatnonzero(common[lo + 1:hi] == to)), hi]
            stack += [(int(a), int(b), to, overlap, alive) for a, b in zip(edges[:-1], edges[1:])]
    return np.array(found, dtype=np.int64).reshape(-1, 2)


def spanning(n: int, pairs: np.ndarray) -> np.ndarray:
    """The least index connected with each of 0..n-1 by ``pairs``."""
    root = np.arange(n)
    while len(pairs):
        a, b = root[pairs[:, 0]], root[pairs[:, 1]]
        low = np.minimum(a, b)
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        if (before == root).all():
            break
    return root

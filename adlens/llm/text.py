"""Vectorised word hashing over Arrow string columns (numpy, inside tasks).

Words are the runs ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes; only A-Z is
lower-cased. Texts are worked through in slices of about ``SLICE`` bytes, so
memory follows the slice (or the longest single text), not the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Java regular expression of a word, for the DataFrame operators.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
SLICE = 1 << 18

_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64): spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int = 0) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                   + np.uint64(seed)) | np.uint64(1)


_BYTE = constants(256, 11)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty texts."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    a = a.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    raw = a.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, off


def slices(off: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each (one text at least)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def _powers(n: int) -> np.ndarray:
    p = np.full(max(n, 1), _BASE, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def word_spans(data: np.ndarray, off: np.ndarray, apart: np.ndarray = _SEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text + total) for texts given by ``off`` into ``data``."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    word = ~apart[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off[off <= n]] = True
    st = word.copy()
    st[1:] &= ~word[:-1] | edge[1:n]
    en = word.copy()
    en[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(st), np.flatnonzero(en) + 1
    return starts, ends, np.searchsorted(starts, off)


def hash_words(data: np.ndarray, off: np.ndarray, apart: np.ndarray = _SEP,
               most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, first word of each text + total).

    ``apart`` marks the bytes between words; ``most`` hashes only the first
    bytes of each word.
    """
    starts, ends, first = word_spans(data, off, apart)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    val = _BYTE[_LOWER[data]]
    val[apart[data]] = 0
    val = val[:ends[-1]]
    lens = np.diff(np.append(starts, ends[-1]))
    pos = np.arange(starts[0], ends[-1]) - np.repeat(starts, lens)
    with np.errstate(over="ignore"):
        val = val[starts[0]:] * _powers(int(lens.max()))[pos]
        if most is not None:
            val[pos >= most] = 0
        h = np.add.reduceat(val, starts - starts[0])
        size = ends - starts if most is None else np.minimum(ends - starts, most)
        return mix(h + size.astype(np.uint64)), first


_POINT = constants(0x10000, 11)  # of code points; the first 256 are those of bytes


def hash_points(points: np.ndarray, apart: np.ndarray, starts: np.ndarray, lens: np.ndarray,
                size: np.ndarray) -> np.ndarray:
    """64-bit hash of every word of code points (already lower-cased); equal to ``hash_words`` for ASCII words.

    A word has ``size`` code points and ``lens`` with the places up to the next word, which ``apart`` marks.
    """
    with np.errstate(over="ignore"):
        val = _POINT[np.minimum(points, 0xFFFF)]
        far = np.flatnonzero(points > 0xFFFF)
        val[far] = mix((points[far].astype(np.uint64) + np.uint64(1)) * _BASE + np.uint64(11)) | np.uint64(1)
        val[apart] = 0
        val = val[starts[0]:] * _powers(int(lens.max()))[np.arange(starts[0], len(points)) - np.repeat(starts, lens)]
        return mix(np.add.reduceat(val, starts - starts[0]) + size.astype(np.uint64))


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each k-word window, first window of each text + total).

    A text with 1..k-1 words has one window, its whole sequence; without words
    it has none.
    """
    c, n = constants(k, 23), len(words)
    count = np.diff(first)
    wins = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    out_first = np.concatenate([[0], np.cumsum(wins)])
    if not n:
        return np.zeros(0, np.uint64), out_first
    with np.errstate(over="ignore"):
        full = np.zeros(n, np.uint64)
        for j in range(min(k, n)):
            full[:n - j] += words[j:] * c[j]
        short = np.flatnonzero((count > 0) & (count < k))
        for d in short:  # fewer than k words: the whole sequence, marked by its length
            a, b = first[d], first[d + 1]
            full[a] = (words[a:b] * c[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a) * _BASE
        owner = np.repeat(np.arange(len(count)), wins)
        at = first[:-1][owner] + np.arange(len(owner)) - out_first[:-1][owner]
        return mix(full[at]), out_first

"""Operator 13: spelling variants grouped by k-d trees over letter counts.

One edit changes the counts of a word's letters by at most two in all: a
replaced letter takes one away and adds one, an inserted or deleted letter
adds or takes one. Counts are written as unary bits ("at least j times the
letter c"), so an L1 distance is a number of differing bits and a plane of a
k-d tree ("c at least j times") is one bit.

Words of a length are dealt to boxes by the upper part of a k-d tree whose
planes are fitted on a bounded sample of that length (``SAMPLE`` words, for
lengths of more than ``BOX`` words); every word is in exactly one box of its
length. A word asks the boxes of its own length and of the next shorter one
that lie within its reach: a box on the other side of a plane costs one of the
letters that may be added or taken away. In a box, the lower part of the tree
is built over all its words; nodes keep the least and largest counts of their
words, and a range search goes on only where these leave room for the letters
to be added and taken away. Words with the right distance of counts are then
compared letter by letter. Pairs never leave a box: what is shuffled is, for each word,
the number of its near words there and the best of them.

Forms: a word's near word with the largest count, if it is ``ratio`` times as
frequent. Roots follow the forms, which grow in count at every step, by joins
that double their reach.

Defined results
---------------
* null and empty texts have no words; an empty table gives no rows.
* null doc_id: counts as an empty one in the damage of runs.
* repeated rows: each counts.
* very long texts and runs: read whole; a box of long words is searched in
  smaller pieces.
* ties of the best near word: the first in code-point order.
* extra columns are not carried, so no name can clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sample import thinned
from .store import saved

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Words of a box, about; words of a length that its planes are fitted on.
BOX, SAMPLE = 4096, 16_000
#: Words of a leaf of the lower tree.
LEAF = 48
#: Numbers (bits' words or letters) that are compared at once.
PIECE = 1 << 21
#: Distinct words a task holds before it passes their counts on.
HELD = 1 << 19


# ---- words ----------------------------------------------------------------


def runs(doc_id, text: str, least: int, damage: int | None) -> Counter:
    """Words of ``least`` code points or more with their places; a run whose crc32 (with the id) is divisible by
    ``damage`` has lost one code point."""
    found = Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
    out: Counter = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for w, n in found.items():
        if len(w) < least:
            continue
        if damage:
            h = zlib.crc32(w.encode(), start)
            if h % damage == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
                if len(w) < least:
                    continue
        out[w] += n
    return out


def word_counts(docs: DataFrame, least_chars: int = 6, least_n: int = 5, damage: int | None = None,
                id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words that occur ``least_n`` times or more in all texts."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                if t.is_valid:
                    held.update(runs(i.as_py(), t.as_py(), least_chars, damage))
                if len(held) >= HELD:
                    yield _told(held)
                    held = Counter()
        if held:
            yield _told(held)

    rows = docs.select(F.col(id).cast("bigint").alias("i"), F.col(text).cast("string").alias("t"))
    counted = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_n)


def _told(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                      names=["word", "n"])


# ---- letter counts as bits ------------------------------------------------


def letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
    return flat.reshape(len(words), -1).astype(np.uint16)


def unary(codes: np.ndarray, planes: list[tuple[int, int]]) -> np.ndarray:
    """(words, planes) bits: whether a word has letter c at least j times."""
    out = np.zeros((len(codes), len(planes)), bool)
    by: dict[int, list] = defaultdict(list)
    for k, (c, j) in enumerate(planes):
        by[c].append((k, j))
    for c, own in by.items():
        n = (codes == c).sum(axis=1)
        for k, j in own:
            out[:, k] = n >= j
    return out


def all_planes(groups: list[np.ndarray]) -> list[tuple[int, int]]:
    """Every (letter, times) that some word of the groups reaches."""
    most: dict[int, int] = {}
    for codes in groups:
        for c in np.unique(codes):
            most[int(c)] = max(most.get(int(c), 0), int((codes == c).sum(axis=1).max()))
    return [(c, j) for c in sorted(most) for j in range(1, most[c] + 1)]


def packed(bits: np.ndarray) -> np.ndarray:
    """Bits as rows of 64-bit words."""
    room = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, room))), axis=1).view(np.uint64)


def _ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int32)


# ---- upper tree: boxes ----------------------------------------------------


def fit_boxes(words: list[str], share: float, box: int = BOX) -> tuple:
    """The planes of one length from a sample that holds ``share`` of its words: nested (letter, times, without,
    with), or a box number."""
    codes = letters(sorted(words))
    planes = all_planes([codes])
    bits, number = unary(codes, planes), iter(range(len(words) + 1))

    def grow(rows: np.ndarray):
        half = np.abs(bits[rows].sum(axis=0) - len(rows) / 2)
        cut = int(np.argmin(half))
        if len(rows) <= max(8, box * share) or half[cut] >= len(rows) / 2:
            return next(number)
        has = bits[rows, cut]
        return (*planes[cut], grow(rows[~has]), grow(rows[has]))

    return grow(np.arange(len(words)))


def reach(tree, codes: np.ndarray, add: int, take: int) -> Iterator[tuple[int, np.ndarray]]:
    """(box, rows of ``codes``) for every box that ``add`` more and ``take`` fewer letters may reach."""
    def visit(node, rows: np.ndarray, up: dict, down: dict) -> Iterator[tuple[int, np.ndarray]]:
        # up and down: letters already added or taken to get here, for each row, by letter
        if not len(rows):
            return
        if not isinstance(node, tuple):
            yield node, rows
            return
        c, j, without, having = node
        n = counts[c][rows]
        more, less = np.maximum(j - n, 0), np.maximum(n - (j - 1), 0)
        for child, own, cost, room in ((having, up, more, add), (without, down, less, take)):
            was = own.get(c, np.zeros(len(rows), np.int64))
            now = {**own, c: np.maximum(was, cost)}
            fit = sum(now.values()) <= room
            pick = {k: v[fit] for k, v in now.items()}
            rest = {k: v[fit] for k, v in (down if own is up else up).items()}
            yield from visit(child, rows[fit], *((pick, rest) if own is up else (rest, pick)))

    counts = {c: (codes == c).sum(axis=1) for c in {p[0] for p in _cuts(tree)}}
    yield from visit(tree, np.arange(len(codes)), {}, {})


def _cuts(node) -> Iterator[tuple[int, int]]:
    if isinstance(node, tuple):
        yield node[:2]
        yield from _cuts(node[2])
        yield from _cuts(node[3])


# ---- lower tree: range search in a box ------------------------------------


class KdTree:
    """A k-d tree over the unary bits of the words of a box."""

    def __init__(self, bits: np.ndarray, leaf: int = LEAF):
        self.bits, self.leaf = packed(bits), leaf
        self.root = self._grow(np.arange(len(bits)), bits)

    def _grow(self, rows: np.ndarray, bits: np.ndarray):
        own = self.bits[rows]
        least, most = np.bitwise_and.reduce(own, axis=0), np.bitwise_or.reduce(own, axis=0)
        if len(rows) > self.leaf:
            half = np.abs(bits[rows].sum(axis=0) - len(rows) / 2)
            cut = int(np.argmin(half))
            if half[cut] < len(rows) / 2:
                has = bits[rows, cut]
                return least, most, None, (self._grow(rows[~has], bits), self._grow(rows[has], bits))
        return least, most, rows, ()

    def search(self, asked: np.ndarray, add: int, take: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows asked, rows of the box) of pairs that differ by ``add`` letters more and ``take`` fewer."""
        wait = [(self.root, np.arange(len(asked)))]
        while wait:
            (least, most, rows, children), who = wait.pop()
            q = asked[who]
            near = (_ones(least & ~q) <= add) & (_ones(q & ~most) <= take)
            who, q = who[near], q[near]
            if not len(who):
                continue
            if rows is None:
                wait += [(c, who) for c in children]
                continue
            own = self.bits[rows]
            step = max(1, PIECE // max(1, own.size))
            for k in range(0, len(who), step):
                part = q[k:k + step, None, :]
                a, b = np.nonzero((_ones(own & ~part) == add) & (_ones(part & ~own) == take))
                if len(a):
                    yield who[k + a], rows[b]


def one_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows differ by one replaced letter, or by one letter that ``a`` has more."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    size = b.shape[1]
    head = np.cumprod(a[:, :size] == b, axis=1).sum(axis=1)
    tail = np.cumprod((a[:, 1:] == b)[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= size


class Best:
    """Near words of each word: how many, and the best of them (largest n, then the first word)."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.order = np.array(sorted(range(len(words)), key=lambda i: (-n[i], words[i])), np.int64)
        self.place = np.empty(len(words), np.int64)
        self.place[self.order] = np.arange(len(words))

    def found(self, size: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of b's of each a of ``size``, row of the best of them or -1)."""
        best = np.full(size, len(self.place))
        np.minimum.at(best, a, self.place[b])
        return np.bincount(a, minlength=size), np.where(best < len(self.place), self.order[np.minimum(best, len(self.order) - 1)], -1)


def near_in_box(words: list[str], n: np.ndarray, asked: list[str], asked_n: np.ndarray) -> list[tuple]:
    """(word, number of near words, best one, its n) from the words of a box and words of one length that ask it."""
    if not words or not asked:
        return []
    own, others = letters(words), letters(asked)
    planes = all_planes([own, others])
    tree, bits = KdTree(unary(own, planes)), packed(unary(others, planes))
    add, take = (1, 1) if own.shape[1] == others.shape[1] else (0, 1)
    step = max(1, PIECE // max(1, others.shape[1]))
    pairs = [(np.zeros(0, np.int64),) * 2]
    for a, b in tree.search(bits, add, take):
        for k in range(0, len(a), step):
            right = one_apart(others[a[k:k + step]], own[b[k:k + step]])
            pairs.append((a[k:k + step][right], b[k:k + step][right]))
    a, b = (np.concatenate(p) for p in zip(*pairs))
    count, best = Best(words, n).found(len(asked), a, b)
    out = [(asked[i], int(count[i]), words[best[i]], int(n[best[i]])) for i in np.flatnonzero(count)]
    if take > add:  # the longer words ask; the shorter ones hear of them too
        count, best = Best(asked, asked_n).found(len(words), b, a)
        out += [(words[i], int(count[i]), asked[best[i]], int(asked_n[best[i]])) for i in np.flatnonzero(count)]
    return out


# ---- Spark ----------------------------------------------------------------


def boxes(words: DataFrame, box: int = BOX, sample: int = SAMPLE) -> dict[int, tuple]:
    """The upper trees of the lengths with more than ``box`` words."""
    sized = words.select("word", F.length("word").alias("size"))
    many = {r["size"]: r["n"] for r in sized.groupBy("size").agg(F.count("*").alias("n")).where(F.col("n") > box).collect()}
    if not many:
        return {}
    by: dict[int, list] = defaultdict(list)
    for r in thinned(sized.where(F.col("size").isin(list(many))), "size", sample, F.col("word")).collect():
        by[r["size"]].append(r["word"])
    return {size: fit_boxes(own, min(1.0, len(own) / many[size]), box) for size, own in by.items()}


DEALT = "size int, box int, asks int, word string, n bigint"


def dealt(words: DataFrame, trees: dict[int, tuple]) -> DataFrame:
    """Every word in its own box (``asks`` 0) and as a question in all boxes within reach (1: same length, 2: the
    next shorter length)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            word, n = b.column("word").to_pylist(), b.column("n").to_numpy()
            size = np.array([len(w) for w in word])
            for s in np.unique(size):
                rows = np.flatnonzero(size == s)
                codes = letters([word[i] for i in rows])
                for asks, of, add, take in ((0, s, 0, 0), (1, s, 1, 1), (2, s - 1, 0, 1)):
                    for box, own in reach(trees.get(int(of), 0), codes, add, take):
                        at = rows[own]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), of, np.int32)), pa.array(np.full(len(at), box, np.int32)),
                             pa.array(np.full(len(at), asks, np.int32)), b.column("word").take(pa.array(at)), pa.array(n[at])],
                            names=["size", "box", "asks", "word", "n"])

    return words.mapInArrow(run, DEALT)


def near_words(words: DataFrame, box: int = BOX, sample: int = SAMPLE) -> DataFrame:
    """(word, n, n_near, near, near_n) of every word of ``words`` (word, n), distinct words."""
    trees = boxes(words, box, sample)
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # work, not bytes, is to be dealt out
    parts = max(parts, sum(1 + len(list(_cuts(t))) for t in trees.values()))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf["asks"] == 0]
        out = []
        for asks in (1, 2):
            q = pdf[pdf["asks"] == asks]
            out += near_in_box(own["word"].tolist(), own["n"].to_numpy(np.int64), q["word"].tolist(), q["n"].to_numpy(np.int64))
        return pd.DataFrame(out, columns=["word", "n_near", "near", "near_n"])

    found = (dealt(words, trees).repartition(parts, "size", "box").groupBy("size", "box")
             .applyInPandas(search, "word string, n_near bigint, near string, near_n bigint"))
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("b"))
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.col("b.near").alias("near"),
        (-F.col("b.m")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): ``forms`` (word, form) followed to the last; rounds grow with the logarithm of the longest chain."""
    now = saved(forms.where("form is not null").select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = saved(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                            F.col("next").isNotNull().alias("more")), "forms")
        now = step.select("word", "root")
        if step.where("more").limit(1).isEmpty():
            return now


def group_variants(words: DataFrame, ratio: int = 5, box: int = BOX, sample: int = SAMPLE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n)."""
    words = saved(words.select("word", "n"), "words")
    big = F.col("near_n") >= ratio * F.col("n")
    told = saved(near_words(words, box, sample).select("word", "n", "n_near", F.when(big, F.col("near")).alias("form"),
                                                       F.when(big, F.col("near_n")).alias("form_n")), "near_words")
    return told.join(roots(told), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

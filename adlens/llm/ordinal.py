"""Operator 10: quality by ordinal cumulative-link regression on graded ratings.

A text is a bag of hashed features: words, word heads and tails (3 bytes) and
two coarse shares (distinct words, line repeats), with weights 1 + log(count)
scaled to length one. One weight vector is shared by all grades; ordered
thresholds cut the line into grades: P(grade > j) = sigmoid(w.x - threshold_j).
The result is the expected grade and the tail probability of a wanted grade.

The model is fitted on all rated texts, whole: Spark tasks fit a part each and
the results are averaged after every round (``labelled``). Scoring reads every
document whole.

Defined results
---------------
* null or empty text: no features, so the thresholds alone decide.
* null ratings teach nothing; without ratings, or with one grade, every text
  gets that grade (0 without any).
* repeated rows: each is returned; empty table: empty result.
* a text rated twice counts with its higher grade.
* extra columns are carried; expected_grade, tail_probability and selected are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx
from .labelled import PART_BYTES, WIDE, averaged, labelled_parts

BITS = 18
RESERVED = ("expected_grade", "tail_probability", "selected")


def _tails(data: np.ndarray, off: np.ndarray, n: int = 3) -> np.ndarray:
    """Hash of the last bytes of every word."""
    starts, ends, _ = tx.word_spans(data, off)
    at = np.maximum(ends[:, None] - np.arange(1, n + 1), starts[:, None])
    with np.errstate(over="ignore"):
        return tx.mix((data[at].astype(np.uint64) * tx.constants(n, 5)).sum(axis=1, dtype=np.uint64))


def features(column, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature numbers, values) of each text."""
    data, off = tx.utf8(column)
    size = np.uint64((1 << bits) - 1)
    for i, j in tx.slices(off):
        own, at = data[off[i]:off[j]], off[i:j + 1] - off[i]
        words, first = tx.hash_words(own, at)
        heads, _ = tx.hash_words(own, at, most=3)
        tails = _tails(own, at) if len(words) else words
        every = [(tx.mix(h ^ np.uint64(k)) & size).astype(np.int64) for k, h in enumerate((words, heads, tails))]
        for d in range(j - i):
            a, b = first[d], first[d + 1]
            if a == b:
                yield np.zeros(0, np.int64), np.zeros(0)
                continue
            share = int(10 * len(np.unique(words[a:b])) / (b - a))
            lines = own[at[d]:at[d + 1]].tobytes().split(b"\n")
            repeats = int(10 * len(set(lines)) / len(lines))
            extra = tx.mix(np.array([share + 100, repeats + 200], np.uint64)) & size
            f, n = np.unique(np.concatenate([x[a:b] for x in every] + [extra.astype(np.int64)]), return_counts=True)
            v = 1 + np.log(n)
            v[np.isin(f, extra.astype(np.int64))] += 3.0  # the two shares stand for the whole text
            yield f, v / np.sqrt((v * v).sum())


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[int]

    def tails(self, f: np.ndarray, v: np.ndarray) -> np.ndarray:
        """P(grade > j) for each threshold j."""
        return 1 / (1 + np.exp(self.thresholds - (self.weights[f] * v).sum()))


def _start(share: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, sums of squared gradients) before the first step: weights, then
    the first threshold and the logarithms of the gaps, from the grades' shares."""
    above = 1 - np.cumsum(share)[:-1]
    start = -np.log(above / (1 - above))
    t = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    values = np.zeros(((1 << bits) // WIDE + -(-len(t) // WIDE), WIDE))
    values.reshape(-1)[1 << bits:][:len(t)] = t
    return values, np.full(values.shape, 1e-8)


def _steps(values: np.ndarray, seen: np.ndarray, texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int, rng,
           bits: int, epochs: int, rate: float = 0.5, decay: float = 1e-5) -> None:
    """Likelihood ascent with per-weight step sizes on grades 0 to ``k - 1``;
    thresholds stay ordered because they are a first value plus positive gaps."""
    (w, cuts), (seen_w, seen_t) = ((x.reshape(-1)[:1 << bits], x.reshape(-1)[1 << bits:][:k - 1]) for x in (values, seen))
    for _ in range(epochs):
        for n in rng.permutation(len(y)):
            f, v = texts[n]
            gaps = cuts[1:]
            t = cuts[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
            s = 1 / (1 + np.exp(t - (w[f] * v).sum()))  # P(grade > j)
            up = 1.0 if y[n] == 0 else s[y[n] - 1]
            down = 0.0 if y[n] == k - 1 else s[y[n]]
            p = max(up - down, 1e-9)
            slope = s * (1 - s)
            g = np.zeros(k - 1)  # d log p / d threshold
            if y[n] > 0:
                g[y[n] - 1] -= slope[y[n] - 1] / p
            if y[n] < k - 1:
                g[y[n]] += slope[y[n]] / p
            gw = -g.sum() * v - decay * w[f]
            seen_w[f] += gw * gw
            w[f] += rate * gw / np.sqrt(seen_w[f])
            gt = np.concatenate([[g.sum()], np.cumsum(g[::-1])[::-1][1:] * np.exp(gaps)])
            seen_t += gt * gt
            cuts += 0.05 * gt / np.sqrt(seen_t)


def _model(values: np.ndarray, grades: list[int], bits: int) -> Model:
    flat, k = values.reshape(-1), len(grades)
    cuts = flat[1 << bits:][:k - 1]
    return Model(flat[:1 << bits], cuts[0] + np.concatenate([[0.0], np.cumsum(np.exp(cuts[1:]))]), grades)


def fit(texts: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, bits: int = BITS, epochs: int = 12) -> Model:
    """The model of texts in memory."""
    found, y, n = np.unique(grades, return_inverse=True, return_counts=True)
    if len(found) < 2:
        return Model(np.zeros(1 << bits), np.zeros(0), found.tolist())
    values, seen = _start(n / len(y), bits)
    _steps(values, seen, texts, y, len(found), np.random.default_rng(7), bits, epochs)
    return _model(values, found.tolist(), bits)


def train(docs: DataFrame, ratings: DataFrame, grade: str = "grade", bits: int = BITS, id: str = "doc_id",
          text: str = "text", rounds: int = 3, epochs: int = 4, part_bytes: int = PART_BYTES) -> Model:
    """Fit on every rated text: ``rounds`` averages of the parts' models, each after ``epochs`` passes over a part."""
    rows = labelled_parts(docs, ratings, grade, id, text, part_bytes)
    n = sorted((r["y"], r["n"]) for r in rows.groupBy(F.col("y").cast("int").alias("y")).agg(F.count("*").alias("n")).collect())
    grades = [g for g, _ in n]
    if len(grades) < 2:
        return Model(np.zeros(1 << bits), np.zeros(0), grades)
    values, seen = _start(np.array([c for _, c in n]) / sum(c for _, c in n), bits)

    def learn(own: np.ndarray, sums: np.ndarray, batches: Iterable[pa.RecordBatch], seed: tuple[int, ...]) -> None:
        texts, y = [], []
        for b in batches:
            texts += [(f.astype(np.int32), v) for f, v in features(b.column("t"), bits)]
            y.append(b.column("y").to_numpy())
        _steps(own, sums, texts, np.searchsorted(grades, np.concatenate(y)), len(grades), np.random.default_rng((7, *seed)),
               bits, epochs)

    averaged(rows.select("part", "t", F.col("y").cast("int").alias("y")), values, seen, learn, rounds)
    return _model(values, grades, bits)


def score(docs: DataFrame, model: Model, wanted: int, cutoff: float = 0.5, text: str = "text") -> DataFrame:
    """``docs`` with expected_grade, tail_probability (grade >= wanted) and selected."""
    rows = docs.select(*[c for c in docs.columns if c not in RESERVED])
    schema = T.StructType([*rows.schema.fields, T.StructField("expected_grade", T.DoubleType()),
                           T.StructField("tail_probability", T.DoubleType()), T.StructField("selected", T.BooleanType())])
    grades = model.grades or [0]
    above = sum(g < wanted for g in grades)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            expected, tail = [], []
            for f, v in features(b.column(text).cast(pa.string()), int(np.log2(len(model.weights)))):
                s = np.concatenate([[1.0], model.tails(f, v), [0.0]])
                expected.append(float((-np.diff(s) * grades).sum()))
                tail.append(float(s[above]))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(expected, pa.float64()), pa.array(tail, pa.float64()),
                 pa.array([t >= cutoff for t in tail], pa.bool_())], names=schema.names)

    return rows.mapInArrow(run, schema)

"""Operator 4: toxicity by a convolutional text classifier (numpy).

A word's embedding is the sum of three hashed rows: the whole word, its first
4 and its first 7 bytes. Filters of several widths run over the words, each
keeps its largest response over the whole text (max pooling), and a logistic
layer turns these into a probability. Thresholds are calibrated by language,
which is read from the text itself (frequent words of each language), and the
score is stretched so that a language's threshold lies at ``AT``.

The model is fitted on all labelled texts, whole: Spark tasks fit a part each
and the results are averaged after every round (``labelled``); the frequent
words and the scores that thresholds are chosen by are counted over all of
them. Scoring reads every document whole.

Defined results
---------------
* null or empty text: the response to no words, the same for all of them.
* null labels teach nothing; without labels of both classes the score is the
  share of label 1 (0 without any).
* repeated rows: each is returned; empty table: empty result.
* a text labelled twice counts as toxic if one label says so.
* a language with fewer than 20 labelled toxic texts uses the threshold of all.
* extra columns are carried; score and predicted are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx
from .labelled import PART_BYTES, WIDE, averaged, labelled_parts
from .store import saved

BUCKETS = 1 << 16
HEADS = (4, 7)
WIDTHS = (1, 2, 3)
DIM = 16
FILTERS = 16
AT = 0.3
PAD = max(WIDTHS)
#: Places (12 bytes each) of the texts that a pass takes in random order.
HELD = 1 << 20
#: Groups of scores that a threshold may lie between.
STEPS = 10_000
#: Of the embeddings, filters, their offsets, the last layer and its offset.
SHAPES = [(1 + len(HEADS), BUCKETS + 1, DIM), *[(w * DIM, FILTERS) for w in WIDTHS], *[(FILTERS,) for _ in WIDTHS],
          (FILTERS * len(WIDTHS),), (1,)]


def hashed(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slices of texts: (3 x places bucket numbers, first place of each text + total).

    Every text is followed by ``PAD`` empty places (bucket ``BUCKETS``). A
    filter starts at each word and at the first empty place, so it never sees
    two texts, and every text has the response to no words.
    """
    data, off = tx.utf8(column)
    for i, j in tx.slices(off):
        own, at = data[off[i]:off[j]], off[i:j + 1] - off[i]
        words, first = tx.hash_words(own, at)
        rows = [words, *(tx.hash_words(own, at, most=m)[0] for m in HEADS)]
        count = np.diff(first)
        place = np.concatenate([[0], np.cumsum(count + PAD)])
        out = np.full((len(rows), place[-1]), BUCKETS, np.int32)
        to = np.arange(len(words)) + np.repeat(place[:-1] - first[:-1], count)
        for k, h in enumerate(rows):
            out[k, to] = (tx.mix(h ^ np.uint64(k + 1)) % np.uint64(BUCKETS)).astype(np.int32)
        yield out, place


class Net:
    """Weights, as views of one matrix with rows of ``WIDE`` numbers (``flat``)."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.view(np.zeros((sum(-(-int(np.prod(s)) // WIDE) for s in SHAPES), WIDE), np.float32))
        self.emb[:] = rng.normal(0, 0.1, self.emb.shape)
        self.emb[:, BUCKETS] = 0
        for w, c in zip(WIDTHS, self.conv):
            c[:] = rng.normal(0, 0.3 / np.sqrt(w), c.shape)
        self.out[:] = rng.normal(0, 0.1, self.out.shape)

    def view(self, flat: np.ndarray) -> Net:
        self.flat, parts, at = flat, [], 0
        for s in SHAPES:
            size = int(np.prod(s))
            rows = -(-size // WIDE)
            parts.append(flat[at:at + rows].reshape(-1)[:size].reshape(s))
            at += rows
        n = len(WIDTHS)
        self.emb, self.conv, self.bias, (self.out, self.out_bias) = parts[0], parts[1:1 + n], parts[1 + n:1 + 2 * n], parts[1 + 2 * n:]
        return self

    def __getstate__(self):
        return self.flat

    def __setstate__(self, flat):
        self.view(flat)

    def embed(self, ids: np.ndarray) -> np.ndarray:
        x = self.emb[0][ids[0]]
        for k in range(1, len(ids)):
            x += self.emb[k][ids[k]]
        return x

    def responses(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """places x FILTERS of each width; the text's own padding ends the windows."""
        n = len(x)
        x = np.concatenate([x, np.zeros((PAD, DIM), np.float32)])
        for w, k in enumerate(WIDTHS):
            z = x[:n] @ self.conv[w][:DIM]
            for o in range(1, k):
                z += x[o:o + n] @ self.conv[w][o * DIM:(o + 1) * DIM]
            yield z + self.bias[w]

    def logits(self, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
        idle = (place[1:, None] - np.arange(1, PAD)).ravel()  # empty places where no filter starts
        best = []
        for z in self.responses(self.embed(ids)):
            z[idle] = -np.inf
            best.append(np.maximum.reduceat(z, place[:-1], axis=0))
        return np.tanh(np.concatenate(best, axis=1)) @ self.out + self.out_bias


def fit(flat: np.ndarray, seen: np.ndarray, texts: Iterable[tuple[np.ndarray, float]], weight: tuple[float, float],
        seed: tuple[int, ...], rate: float = 0.1, batch: int = 16) -> None:
    """One pass of adaptive gradient steps on the weighted logistic loss over
    (places, label) of each text, in random order among some MB of them; only
    the places that max pooling chose pass a gradient back.

    ``flat`` are the weights, ``seen`` their sums of squared gradients; both change.
    """
    net, past, rng = Net.__new__(Net).view(flat), Net.__new__(Net).view(seen), np.random.default_rng((3, *seed))
    some, places = [], 0
    for t, y in texts:
        some.append((t, y))
        places += t.shape[1]
        if places > HELD:
            _steps(net, past, some, weight, rng, rate, batch)
            some, places = [], 0
    _steps(net, past, some, weight, rng, rate, batch)


def _steps(net: Net, past: Net, rows: list[tuple[np.ndarray, float]], weight: tuple[float, float], rng, rate: float,
           batch: int) -> None:
    texts, y = [t for t, _ in rows], np.array([v for _, v in rows], float)
    cost = np.where(y > 0, weight[1], weight[0])

    def step(own: np.ndarray, sums: np.ndarray, g: np.ndarray) -> None:
        sums += g * g
        own -= rate * g / np.sqrt(sums)

    order = rng.permutation(len(y))
    for s in range(0, len(order), batch):
        some = order[s:s + batch]
        place = np.concatenate([[0], np.cumsum([texts[n].shape[1] for n in some])])
        ids = np.concatenate([texts[n] for n in some], axis=1)
        x = net.embed(ids)
        where, pooled = [], []
        for z in net.responses(x):
            at = np.stack([z[a:b - PAD + 1].argmax(axis=0) + a for a, b in zip(place[:-1], place[1:])])
            where.append(at)
            pooled.append(np.take_along_axis(z, at, axis=0))
        h = np.tanh(np.concatenate(pooled, axis=1))
        drop = (rng.random(h.shape) < 0.8).astype(np.float32) / 0.8
        p = 1 / (1 + np.exp(-(h * drop @ net.out + net.out_bias)))
        err = ((p - y[some]) * cost[some] / len(some)).astype(np.float32)
        back = err[:, None] * net.out * drop * (1 - h * h)
        padded = np.concatenate([x, np.zeros((PAD, DIM), np.float32)])
        gx = np.zeros_like(padded)
        for w, k in enumerate(WIDTHS):
            g = back[:, w * FILTERS:(w + 1) * FILTERS]
            gc = np.zeros_like(net.conv[w])
            for o in range(k):
                seen_x = padded[where[w] + o]  # texts x filters x DIM
                gc[o * DIM:(o + 1) * DIM] = np.einsum("tf,tfd->df", g, seen_x)
                np.add.at(gx, where[w] + o, g[:, :, None] * net.conv[w][o * DIM:(o + 1) * DIM].T[None])
            step(net.conv[w], past.conv[w], gc)
            step(net.bias[w], past.bias[w], g.sum(axis=0))
        step(net.out, past.out, (h * drop).T @ err)
        step(net.out_bias, past.out_bias, err.sum(keepdims=True))
        hot = np.flatnonzero(gx[:len(x)].any(axis=1))
        for k in range(len(ids)):
            rows = ids[k][hot]
            own, back_at = np.unique(rows, return_inverse=True)
            g = np.zeros((len(own), DIM), np.float32)
            np.add.at(g, back_at, gx[hot])
            g[own == BUCKETS] = 0
            past.emb[k, own] += g * g
            net.emb[k, own] -= rate * g / np.sqrt(past.emb[k, own])


class Classifier:
    """The net, the frequent words that tell a language, and a threshold for each language."""

    def __init__(self, net: Net | None, share: float, lang_of: np.ndarray, thresholds: np.ndarray):
        self.net, self.share, self.lang_of, self.thresholds = net, share, lang_of, thresholds

    def languages(self, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Most voted language of each text by its frequent words; the last number where none votes."""
        n = len(self.thresholds) - 1
        owner = np.repeat(np.arange(len(place) - 1), np.diff(place))
        vote = self.lang_of[ids[0]]
        some = vote >= 0
        tally = np.bincount(owner[some] * n + vote[some], minlength=(len(place) - 1) * n).reshape(-1, n) if n else None
        if tally is None:
            return np.zeros(len(place) - 1, np.int64)
        return np.where(tally.any(axis=1), tally.argmax(axis=1), n)

    def raw(self, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.net.logits(ids, place).astype(float)))

    def score(self, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
        if self.net is None:
            return np.full(len(place) - 1, self.share)
        p, t = self.raw(ids, place), self.thresholds[self.languages(ids, place)]
        return np.where(p < t, AT * p / t, AT + (1 - AT) * (p - t) / np.maximum(1 - t, 1e-12))


def best_threshold(high: np.ndarray, low: np.ndarray, hits: np.ndarray, n: np.ndarray) -> float:
    """The cut with the largest F1, midway between neighbouring groups of
    scores; a group has its highest and lowest score, its texts of label 1 and all its texts."""
    order = np.argsort(-high, kind="stable")
    hit, told = np.cumsum(hits[order]), np.cumsum(n[order])
    k = int(np.argmax(2 * hit / (told + hits.sum())))
    below = high[order[k + 1]] if k + 1 < len(order) else 0.0
    return float(np.clip((low[order[k]] + below) / 2, 0.02, 0.98))


def frequent_words(rows: DataFrame, frequent: int) -> DataFrame:
    """(lang, bucket): the ``frequent`` words of each language with the largest share of its
    places, where no other language has a larger share of the word."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, own = b.column("lang").to_pylist(), {}
            at = 0
            for ids, place in hashed(b.column("t")):
                for p, q in zip(place[:-1], place[1:]):
                    own.setdefault(lang[at], []).append(ids[0, p:q])
                    at += 1
            for x, parts in own.items():
                bucket, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([x] * len(bucket), pa.string()), pa.array(bucket, pa.int32()),
                                                  pa.array(n, pa.int64())], names=["lang", "bucket", "n"])

    tally = saved(rows.where("lang is not null").select("lang", "t").mapInArrow(run, "lang string, bucket int, n bigint")
                  .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "words")
    share = tally.join(tally.groupBy("lang").agg(F.sum("n").alias("all")), "lang").where(F.col("bucket") != BUCKETS).select(
        "lang", "bucket", (F.col("n") / F.col("all")).alias("share"))
    first = Window.partitionBy("bucket").orderBy(F.col("share").desc(), "lang")
    top = Window.partitionBy("lang").orderBy(F.col("share").desc(), "bucket")
    return (share.withColumn("owner", F.row_number().over(first)).withColumn("place", F.row_number().over(top))
            .where((F.col("owner") == 1) & (F.col("place") <= frequent)).select("lang", "bucket"))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text",
          lang: str = "lang", frequent: int = 30, epochs: int = 3, part_bytes: int = PART_BYTES) -> Classifier:
    """Fit on every labelled text: three quarters for the weights, one for the thresholds.

    The language column is used here only, to learn which frequent words tell
    a language; a score reads the text alone.
    """
    rows = labelled_parts(docs, labels, label, id, text, part_bytes, lang)
    n = {(r["check"], r["y"]): r["n"] for r in rows.groupBy("check", (F.col("y") > 0).alias("y")).agg(F.count("*").alias("n")).collect()}
    words = frequent_words(rows, frequent).collect()
    names = sorted({r["lang"] for r in words})
    lang_of = np.full(BUCKETS + 1, -1, np.int32)
    for r in words:
        lang_of[r["bucket"]] = names.index(r["lang"])
    bad, every = sum(v for (_, y), v in n.items() if y), sum(n.values())
    if bad in (0, every):
        return Classifier(None, bad / max(1, every), lang_of, np.full(len(names) + 1, AT))
    fitted, checked = rows.where("not check"), rows.where("check")
    if not all(n.get(k) for k in ((True, True), (False, True), (False, False))):
        fitted = checked = rows
        n = {(False, True): bad, (False, False): every - bad}
    net = Net()
    seen = np.full(net.flat.shape, 1e-6, np.float32)
    own = n[False, True] / (n[False, True] + n[False, False])
    weight = (0.5 / (1 - own), 0.5 / own)

    def learn(flat: np.ndarray, sums: np.ndarray, batches: Iterable[pa.RecordBatch], seed: tuple[int, ...]) -> None:
        fit(flat, sums, labelled_places(batches), weight, seed)

    averaged(fitted.select("part", "t", "y"), net.flat, seen, learn, epochs)
    model = Classifier(net, bad / every, lang_of, np.full(len(names) + 1, 0.5))
    told = scored_groups(checked, model)
    cuts = {k: best_threshold(*(np.array(told[c].to_numpy())[told["lang"].to_numpy() == k] for c in ("high", "low", "hits", "n")))
            for k in range(len(names) + 1) if told["hits"].to_numpy()[told["lang"].to_numpy() == k].sum() >= 20}
    whole = told.group_by("score").aggregate([("high", "max"), ("low", "min"), ("hits", "sum"), ("n", "sum")])
    of_all = best_threshold(*(whole[c].to_numpy() for c in ("high_max", "low_min", "hits_sum", "n_sum")))
    model.thresholds[:] = [cuts.get(k, of_all) for k in range(len(names) + 1)]
    return model


def labelled_places(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, float]]:
    """(places, 0 or 1) of each labelled text."""
    for b in batches:
        y, at = b.column("y").to_numpy(zero_copy_only=False) > 0, 0
        for ids, place in hashed(b.column("t")):
            for p, q in zip(place[:-1], place[1:]):
                yield ids[:, p:q], float(y[at])
                at += 1


def scored_groups(rows: DataFrame, model: Classifier) -> pa.Table:
    """(lang, score, high, low, hits, n): the labelled texts by language and score in steps of 1 / ``STEPS``."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in batches:
            got = [(own.languages(ids, place), own.raw(ids, place)) for ids, place in hashed(b.column("t"))]
            lang, p = (np.concatenate(x) for x in zip(*got)) if got else (np.zeros(0, np.int64), np.zeros(0))
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(p, pa.float64()),
                                              pa.array(b.column("y").to_numpy(zero_copy_only=False) > 0)], names=["lang", "p", "y"])

    return (rows.select("t", "y").mapInArrow(run, "lang int, p double, y boolean")
            .groupBy("lang", F.floor(F.col("p") * STEPS).cast("int").alias("score"))
            .agg(F.max("p").alias("high"), F.min("p").alias("low"), F.sum(F.col("y").cast("bigint")).alias("hits"),
                 F.count("*").alias("n")).toArrow())


def classify(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``AT`` on)."""
    rows = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    sent = rows.sparkSession.sparkContext.broadcast(model)  # fixed size: BUCKETS rows of DIM numbers, three times

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in batches:
            s = [own.score(ids, place) for ids, place in hashed(b.column(text).cast(pa.string()))]
            s = np.concatenate(s) if s else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(s, pa.float64()), pa.array((s >= AT).astype(np.int32))], names=schema.names)

    return rows.mapInArrow(run, schema)

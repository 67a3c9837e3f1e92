"""Operator 5: language identification by rank-order n-gram profiles.

A profile is a language's ``top`` most frequent character n-grams (1 to 4
letters, words padded by a space) in order. A document's own ranking is
compared with each profile: every n-gram of the document costs the difference
of its two ranks, or ``top`` where the profile lacks it; the language with the
least sum wins.

Profiles are learned from about ``per_lang`` labelled documents of each
language (chosen by a hash of id and text), read whole.
Prediction reads every document whole.

Defined results
---------------
* null text, or a text without a letter: ``und``, score 0.
* ties in an n-gram ranking: by n-gram code; ties of languages: by name.
* null labels teach nothing; without any label every text is ``und``.
* repeated rows: each is returned; empty table: empty result.
* extra columns are carried; lang_pred and score are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sample import thinned
from .text import constants

TOP = 400
LONGEST = 4
PER_LANG = 400
BLANK = 32

_MULT = (constants(LONGEST + 1, 41) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text; every run of other characters is one blank."""
    low = text.lower()
    cp = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    small = cp < 0x250
    ok = np.zeros(len(cp), dtype=bool)
    ok[small] = _ALPHA[cp[small]]
    if not small.all():
        odd, back = np.unique(cp[~small], return_inverse=True)
        ok[~small] = np.array([chr(c).isalpha() for c in odd])[back]
    if not ok.any():
        return np.zeros(0, np.uint32)
    cp = np.where(ok, cp, BLANK).astype(np.uint32)
    cp = np.concatenate([[BLANK], cp, [BLANK]]).astype(np.uint32)
    keep = np.ones(len(cp), dtype=bool)
    keep[1:] = (cp[1:] != BLANK) | (cp[:-1] != BLANK)
    return cp[keep]


_ALPHA = np.array([chr(c).isalpha() for c in range(0x250)])


def ngrams(text: str) -> np.ndarray:
    """32-bit codes of all n-grams; a blank stands only at an n-gram's ends."""
    cp = letters(text)
    if not len(cp):
        return cp
    blank = cp == BLANK
    out, code = [cp[~blank] * _MULT[0]], cp * _MULT[0]
    inner = np.zeros(len(cp), dtype=bool)  # a blank inside the n-gram
    for n in range(2, LONGEST + 1):
        if len(cp) < n:
            break
        code = code[:len(cp) - n + 1] * np.uint32(0x01000193) + cp[n - 1:] * _MULT[n - 1]
        if n > 2:
            inner = inner[:len(cp) - n + 1] | blank[n - 2:len(cp) - 1]
            out.append(code[~inner])
        else:
            inner = inner[:len(cp) - 1]
            out.append(code)
    x = np.concatenate(out)
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    return x ^ (x >> np.uint32(13))


def counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = np.sort(codes)
    edge = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[edge], np.diff(np.append(edge, len(s)))


def ranking(text: str, top: int = TOP) -> np.ndarray:
    """The text's most frequent n-grams, most frequent first."""
    codes = ngrams(text)
    if not len(codes):
        return codes
    code, n = counts(codes)
    key = (n.astype(np.uint64) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - code.astype(np.uint64))
    if len(key) > top:
        key = np.partition(key, len(key) - top)[-top:]
    key = np.sort(key)[::-1]
    return (np.uint64(0xFFFFFFFF) - (key & np.uint64(0xFFFFFFFF))).astype(np.uint32)


class Profiles:
    """Rank tables of all languages."""

    def __init__(self, rows: list[tuple[str, int, int]], top: int = TOP):
        self.top = top
        self.langs = sorted({r[0] for r in rows})
        self.tables = []
        for lang in self.langs:
            own = sorted((c, k) for x, c, k in rows if x == lang)
            self.tables.append((np.array([c for c, _ in own], np.uint32), np.array([k for _, k in own], np.int64)))

    def distances(self, rank: np.ndarray) -> np.ndarray:
        """Out-of-place distance to each language as a share of the largest possible."""
        place = np.arange(len(rank))
        out = []
        for codes, ranks in self.tables:
            at = np.minimum(np.searchsorted(codes, rank), len(codes) - 1)
            cost = np.where(codes[at] == rank, np.abs(ranks[at] - place), self.top)
            out.append(np.minimum(cost, self.top).sum() / (self.top * len(rank)))
        return np.array(out)

    def predict(self, text: str | None) -> tuple[str, float]:
        rank = ranking(text, self.top) if text else np.zeros(0)
        if not len(rank) or not self.langs:
            return "und", 0.0
        d = self.distances(rank)
        best = int(np.argmin(d))
        return self.langs[best], float(min(max(1.0 - d[best], 0.0), 1.0))


def learn(labelled: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang",
          per_lang: int = PER_LANG, top: int = TOP) -> Profiles:
    """Profiles from about ``per_lang`` labelled documents of each language.

    Only ``top`` n-grams of each language reach the driver.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(id).alias("i"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("t"))
    sample = thinned(rows, "lang", per_lang, F.col("i"), F.col("t")).select("lang", "t")

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own: dict[str, list] = {}
            for x, t in zip(b.column("lang").to_pylist(), b.column("t").to_pylist()):
                own.setdefault(x, []).append(ngrams(t))
            for x, parts in own.items():
                code, n = counts(np.concatenate(parts)) if sum(map(len, parts)) else (np.zeros(0, np.uint32),) * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x] * len(code), pa.string()), pa.array(code.astype(np.int64)),
                     pa.array(n.astype(np.int64))], names=["lang", "code", "n"])

    total = sample.mapInArrow(tally, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "code")) - 1
    best = total.withColumn("k", place).where(F.col("k") < top)
    return Profiles([tuple(r) for r in best.select("lang", "code", "k").collect()], top)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    rows = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "score")])
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [profiles.predict(x.as_py()) for x in b.column(text).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=schema.names)

    return rows.mapInArrow(predict, schema)


def held_out(modulus: int, remainder: int, id: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text, by its remainder."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))

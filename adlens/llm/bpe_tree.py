"""Operator 8: BPE encoding and decoding by tree concatenation.

Short texts are encoded where they lie. A text over ``piece`` characters is
normalised once, cut into pieces that Spark deals out to tasks, and put
together again in a tree: neighbours are joined by encoding a window of text
around the cut and growing it until the window's tokens agree with the left
half before the cut and with the right half after it. Only the tokens between
those two places are replaced.

The words (pre-tokens) of a text are encoded by the tokenizer's own BPE model,
each distinct word once per task while the bounded cache has room.

Defined results
---------------
* null text: as the empty text, no tokens; empty table: empty result.
* repeated rows: each row is returned, with equal results.
* very long texts: cut and joined as above; runs without any space are joined
  inside the run.
* extra columns are carried as they are; the names in ``RESERVED`` are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import fresh

PIECE = 65536
CACHE = 100_000
#: Characters that a word rule of the tokenizer can look ahead, and some more.
AHEAD = 8
RESERVED = ("ids", "decoded")


class Tokenizer:
    """Encodes normalised text word by word; built once per task from a vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Library

        with open(path, encoding="utf-8") as f:
            raw = f.read()
        spec = json.loads(raw)
        self.library = Library.from_str(raw)
        self.model = self.library.model
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_re = regex.compile("|".join(regex.escape(s) for s in self.specials)) if self.specials else None
        steps = spec["pre_tokenizer"]["pretokenizers"]
        # A word rule that names Unicode classes; used where class tables cannot differ between libraries.
        self.word_re = regex.compile(steps[0]["pattern"]["Regex"])
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        vocab = {**spec["model"]["vocab"], **self.specials}
        self.byte_char = _byte_chars()
        words = [""] * (max(vocab.values()) + 1)
        for w, i in vocab.items():
            words[i] = w
        ended = [w.endswith(self.suffix) if self.suffix else False for w in words]
        self.ended = np.array(ended)
        #: Bytes of text under each token (vocabulary letters stand for one byte each).
        self.width = np.array([len(w) - len(self.suffix) * e for w, e in zip(words, ended)])
        shown = [w.encode() + b" " for w in words]
        self.shown = np.frombuffer(b"".join(shown), dtype=np.uint8)
        self.shown_len = np.array([len(w) for w in shown])
        self.shown_at = np.cumsum(self.shown_len) - self.shown_len
        self.cache: dict[str, bytes] = {}

    def normalise(self, text: str) -> str:
        """The tokenizer's normal form (white space is dropped later in any case)."""
        if text.isascii() or max(text) < "ɐ":  # composed already; lower case is per letter
            return text.lower()
        return self.library.normalizer.normalize_str(text)

    def words(self, norm: str) -> list[str]:
        if norm.isascii() or max(norm, default="") < "ɐ":
            return self.word_re.findall(norm)
        return [norm[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(norm)]

    def spans(self, norm: str) -> list[tuple[int, int]]:
        """Character range of each word."""
        if norm.isascii() or max(norm, default="") < "ɐ":
            return [m.span() for m in self.word_re.finditer(norm)]
        return [s for _, s in self.library.pre_tokenizer.pre_tokenize_str(norm)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        cache, own = self.cache, {}
        for w in words:
            if w not in cache and w not in own:
                tokens = self.model.tokenize(w.encode().decode("latin-1").translate(self.byte_char))
                ids = np.array([t.id for t in tokens], dtype="<u4").tobytes()
                (cache if len(cache) < CACHE else own)[w] = ids
        return [cache[w] if w in cache else own[w] for w in words] if own else [cache[w] for w in words]

    def segments(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is special, normalised text or special string) in order."""
        at = 0
        for m in self.special_re.finditer(text) if self.special_re else ():
            if m.start() > at:
                yield False, self.normalise(text[at:m.start()])
            yield True, m[0]
            at = m.end()
        if at < len(text):
            yield False, self.normalise(text[at:])

    def encode(self, text: str) -> np.ndarray:
        out = []
        for special, part in self.segments(text):
            out += [np.uint32(self.specials[part]).tobytes()] if special else self.encode_words(self.words(part))
        return np.frombuffer(b"".join(out), dtype="<u4")

    def encode_at(self, norm: str, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(ids, byte offset of each token) of normalised text."""
        spans = self.spans(norm)
        parts = self.encode_words([norm[a:b] for a, b in spans])
        ids = np.frombuffer(b"".join(parts), dtype="<u4")
        if not len(ids):
            return ids, np.zeros(0, np.int64)
        if norm.isascii():
            starts = np.array([a for a, _ in spans])
        else:
            sizes = np.concatenate([[0], np.cumsum([len(c.encode()) for c in norm])])
            starts = sizes[[a for a, _ in spans]]
        count = np.array([len(p) // 4 for p in parts])
        width = self.width[ids]
        inner = np.cumsum(width) - width
        first = np.cumsum(count) - count
        return ids, inner + np.repeat(starts - inner[np.minimum(first, len(ids) - 1)], count) + base

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens' strings joined by spaces: this vocabulary has no decoder."""
        if not len(ids):
            return b""
        size = self.shown_len[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(self.shown_at[ids] - ends + size, size)
        return self.shown[at].tobytes()[:-1]


def _byte_chars() -> dict[int, str]:
    """Byte -> letter of byte-level vocabularies: printable Latin-1 stands for
    itself, the other bytes follow from U+0100 in order."""
    same = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(same)]
    return {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(rest)}


def cut(norm: str, piece: int) -> list[str]:
    """Halves of halves until each has at most ``piece`` characters."""
    if len(norm) <= piece:
        return [norm]
    mid = len(norm) // 2
    return cut(norm[:mid], piece) + cut(norm[mid:], piece)


def _agreement(one: tuple, two: tuple, lo: int, hi: int, ended: np.ndarray, want: int) -> tuple[int, int] | None:
    """Token indices (of one, of two) from which both go on alike, by tokens within bytes [lo, hi).

    Both must hold the same tokens at the same places. A common end of a word
    is enough, because words are found from left to right without memory;
    inside a word, ``want`` consecutive common tokens are asked for: neighbours
    that stand side by side in valid encodings make a valid encoding.
    """
    (a, pa_), (b, pb) = one, two
    ia = np.arange(np.searchsorted(pa_, lo), np.searchsorted(pa_, hi))
    ib = np.arange(np.searchsorted(pb, lo), np.searchsorted(pb, hi))
    _, ka, kb = np.intersect1d(pa_[ia], pb[ib], assume_unique=True, return_indices=True)
    ia, ib = ia[ka], ib[kb]
    same = a[ia] == b[ib]
    ia, ib = ia[same], ib[same]
    if not len(ia):
        return None
    stop = np.flatnonzero(ended[a[ia]])
    if len(stop):
        k = stop[len(stop) // 2]
        return int(ia[k]) + 1, int(ib[k]) + 1
    run = np.split(np.arange(len(ia)), np.flatnonzero((np.diff(ia) != 1) | (np.diff(ib) != 1)) + 1)
    best = max(run, key=len)
    if len(best) < want:
        return None
    k = best[len(best) // 2]
    return int(ia[k]), int(ib[k])


def join(tok: Tokenizer, text: bytes, left: tuple, right: tuple, lo: int, mid: int, hi: int,
         window: int = 64, want: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of text[lo:hi] from those of text[lo:mid] and text[mid:hi]."""
    while True:
        a, b = max(lo, mid - window), min(hi, mid + window)
        while a > lo and text[a] & 0xC0 == 0x80:
            a -= 1
        while b < hi and text[b] & 0xC0 == 0x80:
            b += 1
        mine = tok.encode_at(text[a:b].decode(), a)
        # word ends within AHEAD bytes of a cut may still change
        at_left = (0, 0) if a == lo else _agreement(left, mine, a, mid - AHEAD - 1, tok.ended, want)
        at_right = ((len(right[0]), len(mine[0])) if b == hi else
                    _agreement(right, mine, mid, b - AHEAD - 1, tok.ended, want))
        if at_left and at_right and at_left[1] <= at_right[1]:
            (i, u), (y, v) = at_left, at_right
            return tuple(np.concatenate([left[k][:i], mine[k][u:v], right[k][y:]]) for k in (0, 1))
        window *= 2


def merge(tok: Tokenizer, pieces: list[str], encoded: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Ids of the concatenated pieces, joined pairwise level by level."""
    raw = [p.encode() for p in pieces]
    ends = np.cumsum([len(r) for r in raw])
    text = b"".join(raw)
    level = [(int(e - len(r)), int(e), (ids, at + int(e - len(r)))) for r, e, (ids, at) in zip(raw, ends, encoded)]
    while len(level) > 1:
        nxt = []
        for k in range(0, len(level) - 1, 2):
            (lo, mid, left), (_, hi, right) = level[k], level[k + 1]
            nxt.append((lo, hi, join(tok, text, left, right, lo, mid, hi)))
        level = nxt + level[len(level) - len(level) % 2:]
    return level[0][2][0] if level else np.zeros(0, "<u4")


_tokenizers: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of this Python worker, for steps that are called group by group."""
    if path not in _tokenizers:
        _tokenizers[path] = Tokenizer(path)
    return _tokenizers[path]


PIECES = T.StructType([T.StructField("rid", T.BinaryType()), T.StructField("seg", T.IntegerType()),
                       T.StructField("k", T.IntegerType()), T.StructField("special", T.StringType()),
                       T.StructField("piece", T.StringType())])
CODED = T.StructType([*PIECES.fields, T.StructField("ids", T.BinaryType()), T.StructField("at", T.BinaryType())])


def encode(docs: DataFrame, path: str, text: str = "text", piece: int = PIECE, ids_only: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` (string).

    ``path`` names the vocabulary file, which must lie on every executor.
    """
    keep = [c for c in docs.columns if c not in RESERVED]
    rows = docs.select(*keep)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    long = F.length(body) > piece
    schema = T.StructType([*rows.schema.fields, T.StructField("ids", T.BinaryType()),
                           *([] if ids_only else [T.StructField("decoded", T.StringType())])])

    def short(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Tokenizer(path)  # goes with the task: workers live on, in other stages
        for b in batches:
            for s in range(0, b.num_rows, 500):
                part = b.slice(s, 500)
                ids = [tok.encode(x or "") for x in part.column(text).cast(pa.string()).to_pylist()]
                extra = [pa.array([x.tobytes() for x in ids], pa.binary())]
                if not ids_only:
                    extra.append(pa.array([tok.decode(x).decode() for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], names=schema.names)

    done = rows.where(~long).mapInArrow(short, schema)

    # A text is known by its digest, so copies and repeated rows share one encoding.
    own = fresh(rows, "rid")
    numbered = rows.where(long).withColumn(own, F.unhex(F.sha2(F.encode(body, "UTF-8"), 256)))

    def cuts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Tokenizer(path)  # goes with the task: workers live on, in other stages
        for b in batches:
            for rid, x in zip(b.column("rid").to_pylist(), b.column("t").to_pylist()):
                out = [(rid, s, k, part if special else None, p) for s, (special, part) in enumerate(tok.segments(x))
                       for k, p in enumerate([""] if special else cut(part, piece))]
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(PIECES.names, o)) for o in out], _arrow(PIECES))

    def leaves(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Tokenizer(path)  # goes with the task: workers live on, in other stages
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                ids, at = tok.encode_at(one.column("piece")[0].as_py())
                yield pa.RecordBatch.from_arrays(
                    [*one.columns, pa.array([ids.tobytes()], pa.binary()),
                     pa.array([at.astype("<i8").tobytes()], pa.binary())], names=CODED.names)

    def together(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tok, out = tokenizer(path), []
        for _, seg in pdf.sort_values(["seg", "k"]).groupby("seg"):
            special = seg["special"].iloc[0]
            if special:
                out.append(np.array([tok.specials[special]], "<u4"))
            else:
                out.append(merge(tok, list(seg["piece"]), [
                    (np.frombuffer(i, "<u4"), np.frombuffer(a, "<i8")) for i, a in zip(seg["ids"], seg["at"])]))
        ids = np.concatenate(out) if out else np.zeros(0, "<u4")
        return pd.DataFrame({"_rid": [key[0]], "ids": [ids.tobytes()],
                             **({} if ids_only else {"decoded": [tok.decode(ids).decode()]})})

    pieces = numbered.select(F.col(own).alias("rid"), body.alias("t")).mapInArrow(cuts, PIECES)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # work, not bytes, is to be dealt out
    coded = pieces.dropDuplicates(["rid", "seg", "k"]).repartition(parts, "rid", "seg", "k").mapInArrow(leaves, CODED)
    more = T.StructType([T.StructField("_rid", T.BinaryType()), *schema.fields[len(keep):]])
    joined = coded.groupBy("rid").applyInPandas(together, more)
    return done.unionByName(numbered.join(joined.withColumnRenamed("_rid", own), own).drop(own).select(*schema.names))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def digests(docs: DataFrame, path: str, text: str = "text", piece: int = PIECE) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    out = encode(docs.select("doc_id", text), path, text, piece)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))

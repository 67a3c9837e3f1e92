"""Operators 8 and 9 against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer as Library

from adlens.llm import bpe_tree, token_cache
from adlens.llm.queries import vocabulary
from adlens.session import scratch_path

from .cases import LONG, UNSPLIT, empty, frame, rows

ALPHABETS = [
    ["a", "e", "th", "ing", "'s", "'ll", "'", "!!", "?", " ", "\n", "1", "23", "É", "ß", "ñ", "日本", "é", "<|endoftext|>",
     "<|startoftext|>", "́", "😀", "İ", "ǅ", "Ω", "Σ", "z", "\x0b", " ", "-", "--", "\x00"],
    ["a", "e", "i", "n", "t", "h", "s", "ing", "er"], ["a", "b"], ["a", "e", "th", "ing", "'s", "'ll", "'", "!!", "?", " "],
]


@pytest.fixture(scope="module")
def words():
    return bpe_tree.Tokenizer(vocabulary("word_bpe_49k.json")), Library.from_file(vocabulary("word_bpe_49k.json"))


def by_tree(tok, text, piece):
    out = []
    for special, part in tok.segments(text):
        if special:
            out.append(np.array([tok.specials[part]], "<u4"))
        else:
            pieces = bpe_tree.cut(part, piece)
            out.append(bpe_tree.merge(tok, pieces, [tok.encode_at(p) for p in pieces]))
    return np.concatenate(out).tolist() if out else []


@pytest.mark.parametrize("kind", range(4))
def test_tree_equals_the_library(words, kind):
    tok, lib = words
    rnd = random.Random(kind)
    for _ in range(150):
        x = "".join(rnd.choice(ALPHABETS[kind]) for _ in range(rnd.randint(0, 900)))
        want = lib.encode(x, add_special_tokens=False).ids
        assert tok.encode(x).tolist() == want
        assert by_tree(tok, x, rnd.choice([16, 40, 100])) == want
        assert tok.decode(np.array(want, "<u4")).decode() == lib.decode(want, skip_special_tokens=False)


def expect(lib, text):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_round_trip_over_spark(spark, words):
    """Awkward rows, with pieces short enough that texts are cut."""
    _, lib = words
    want = sorted(((r[0], *expect(lib, r[1])) for r in rows()), key=str)
    for piece in (bpe_tree.PIECE, 3000):
        got = bpe_tree.digests(frame(spark), vocabulary("word_bpe_49k.json"), piece=piece).collect()
        assert sorted(map(tuple, got), key=str) == want
    assert bpe_tree.encode(empty(spark), vocabulary("word_bpe_49k.json")).count() == 0


def test_extra_columns_are_carried(spark):
    df = frame(spark)
    out = bpe_tree.encode(df, vocabulary("word_bpe_49k.json"), piece=3000)
    assert out.columns == [c for c in df.columns if c != "ids"] + ["ids", "decoded"]
    assert {r.sid for r in out.collect()} == {"x", None}


def test_special_strings_and_runs_without_space(words):
    tok, lib = words
    x = UNSPLIT[:20000] + "<|endoftext|>" + LONG[:3000]
    assert by_tree(tok, x, 500) == lib.encode(x, add_special_tokens=False).ids


def test_counts_equal_the_library_and_the_cache_fills(spark):
    path, cache = vocabulary("byte_bpe_50k.json"), scratch_path(spark, "t_cache")
    lib = Library.from_file(path)
    n = lambda t: len(lib.encode(t or "", add_special_tokens=False).ids)
    df = frame(spark)
    want = sorted(((r[0], len((r[1] or "").encode()), n(r[1]), n(r[1]) > 512) for r in rows()), key=str)

    def run(d):
        return sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit)
                       for r in token_cache.count_tokens(d, path, cache).collect()), key=str)
    assert run(df) == want
    stored = spark.read.parquet(cache)
    distinct = len({r[1] or "" for r in rows()})
    assert stored.count() == distinct and stored.select("digest").distinct().count() == distinct
    assert run(df) == want and spark.read.parquet(cache).count() == distinct      # nothing is encoded again
    more = spark.createDataFrame([(99, "new text <|endoftext|>"), (98, rows()[0][1])], "doc_id long, text string")
    assert run(more) == sorted([(99, 22, n("new text <|endoftext|>"), False), (98, len(rows()[0][1]), n(rows()[0][1]), False)], key=str)
    assert spark.read.parquet(cache).count() == distinct + 1
    assert run(empty(spark)) == []


def test_counts_of_another_tokenizer_are_not_used(spark):
    path, cache = vocabulary("byte_bpe_50k.json"), scratch_path(spark, "t_cache")
    df = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    digest = hashlib.sha256(b"some text").digest()
    spark.createDataFrame([("other", bytearray(digest), 999)], token_cache.CACHE_SCHEMA).write.parquet(cache)
    assert token_cache.count_tokens(df, path, cache).first().n_tokens == 2


def test_only_unknown_texts_are_encoded(spark):
    """A count that is stored is joined as it is, wrong or not; other copies and texts are encoded once."""
    path, cache = vocabulary("byte_bpe_50k.json"), scratch_path(spark, "t_cache")
    token_cache.fill_cache(spark.createDataFrame([(1, "one text")], "doc_id long, text string"), path, cache)
    stored = spark.createDataFrame([(token_cache.version(path), bytearray(hashlib.sha256(b"known").digest()), 777)],
                                   token_cache.CACHE_SCHEMA)
    stored.write.mode("append").parquet(cache)
    docs = spark.createDataFrame([(2, "known"), (None, "known"), (3, "one text"), (4, "new"), (None, "new"), (5, "other new")],
                                 "doc_id long, text string")
    got = {(r.doc_id, r.text): r.n_tokens for r in token_cache.count_tokens(docs, path, cache).collect()}
    lib = Library.from_file(path)
    assert got[2, "known"] == got[None, "known"] == 777
    for k in ((3, "one text"), (4, "new"), (None, "new"), (5, "other new")):
        assert got[k] == len(lib.encode(k[1], add_special_tokens=False).ids)
    assert spark.read.parquet(cache).count() == 4

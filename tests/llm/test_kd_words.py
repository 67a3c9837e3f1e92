"""Operator 13 against plain Python."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.llm import kd_words as kd

from .cases import empty, frame, rows


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts, ratio=5):
    form, told = {}, {}
    for w in counts:
        close = sorted((-counts[v], v) for v in counts if v != w and near(w, v))
        ok = bool(close) and -close[0][0] >= ratio * counts[w]
        form[w] = close[0][1] if ok else None
        told[w] = (counts[w], len(close), -close[0][0] if ok else None)
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, *told[w]))
    return sorted(out)


def plain_words(docs, least_chars, least_n, damage):
    total = Counter()
    for i, t in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        run = ""
        for c in low + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if damage and h % damage == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                if len(run) >= least_chars:
                    total[run] += 1
            run = ""
    return {w: n for w, n in total.items() if n >= least_n}


def family(seed, n=500):
    rnd = random.Random(seed)
    words = Counter()
    while len(words) < n:
        w = "".join(rnd.choice(["ab", "ca", "é", "ta", "o", "st", "re"]) for _ in range(rnd.randint(2, 6)))
        for _ in range(rnd.randint(0, 4)):
            k, c = rnd.randrange(len(w)), rnd.choice("abcéost")
            v = rnd.choice([w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:]])
            words[v] = rnd.choice([5, 6, 7, 30, 200])
        words[w] = rnd.choice([5, 40, 300, 2000])
    return dict(words)


@pytest.mark.parametrize("box, sample", [(4096, 16_000), (20, 16_000), (20, 60)])
def test_groups_equal_plain_python(spark, monkeypatch, box, sample):
    counts = family(box)
    counts.update({"aabbcc": 5, "bbaacc": 25, "aabbcd": 25, "abcabc": 6, "x" * 300: 5, "x" * 299: 25, "x" * 301: 25})
    monkeypatch.setattr(kd, "LEAF", 4)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert sorted(tuple(r) for r in kd.group_variants(df, box=box, sample=sample).collect()) == plain(counts)


def test_boxes_hold_every_word_once_and_questions_reach_all_near_ones():
    words = [w for w in family(9, 900) if len(w) == 8]
    tree = kd.fit_boxes(words, 1.0, box=10)
    codes = kd.letters(words)
    home = {}
    for box, own in kd.reach(tree, codes, 0, 0):
        for i in own:
            assert i not in home
            home[i] = box
    assert len(home) == len(words) and len(set(home.values())) > 5
    asked = {(i, box) for box, own in kd.reach(tree, codes, 1, 1) for i in own}
    assert all((i, home[j]) in asked for i in range(len(words)) for j in range(len(words)) if near(words[i], words[j]))
    assert len(asked) < 0.9 * len(words) * len(set(home.values()))


def test_tree_finds_all_counts_in_range():
    words = [w for w in family(11, 700) if len(w) == 9]
    longer = [w for w in family(12, 700) if len(w) == 10]
    planes = kd.all_planes([kd.letters(words), kd.letters(longer)])
    own, more = kd.unary(kd.letters(words), planes), kd.unary(kd.letters(longer), planes)
    tree = kd.KdTree(own, leaf=5)
    for asked, add, take in ((own, 1, 1), (more, 0, 1)):
        got = {(int(x), int(y)) for a, b in tree.search(kd.packed(asked), add, take) for x, y in zip(a, b)}
        want = {(i, j) for i in range(len(asked)) for j in range(len(own))
                if (own[j] & ~asked[i]).sum() == add and (asked[i] & ~own[j]).sum() == take}
        assert got == want and got


def test_one_apart():
    def pair(a, b):
        return bool(kd.one_apart(kd.letters([a]), kd.letters([b]))[0])

    assert pair("abc", "abd") and not pair("abc", "abc") and not pair("abc", "bac")
    assert pair("abc", "ab") and pair("abc", "bc") and pair("abc", "ac") and pair("aaa", "aa") and not pair("abc", "ca")


def test_words_and_their_damage(spark):
    rnd = random.Random(1)
    docs = [(n, " ".join(rnd.choice(["Variant", "ÉCOLE-école", "mot×mot", "tiny", "colour7color"]) for _ in range(30))) for n in range(60)]
    docs += [(None, "Variant " * 9), (61, None), (62, ""), (3, docs[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for damage in (None, 7, 199):
        got = {r.word: r.n for r in kd.word_counts(df, 5, 3, damage).collect()}
        assert got == plain_words(docs, 5, 3, damage) and got


def test_awkward(spark):
    docs = [(r[0], r[1]) for r in rows()]
    df = frame(spark).withColumns({"word": F.lit("x"), "n": F.lit(1), "size": F.lit(2), "box": F.lit(3)})
    words = kd.word_counts(df, 1, 1, 3)
    want = plain(plain_words(docs, 1, 1, 3))
    assert sorted(tuple(r) for r in kd.group_variants(words).collect()) == want
    assert kd.group_variants(kd.word_counts(empty(spark))).count() == 0


def test_boxes_are_fitted_on_a_bounded_sample(spark):
    rnd = np.random.default_rng(2)
    words = sorted({"".join(rnd.choice(list("abcdefgh"), 9)) for _ in range(3000)})
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    trees = kd.boxes(df, box=200, sample=400)
    assert set(trees) == {9} and len(list(kd._cuts(trees[9]))) + 1 > 8
    assert kd.boxes(df, box=5000) == {}

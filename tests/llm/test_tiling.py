"""Operator 3 against a plain greedy tiling of the words."""

import random
import re

import numpy as np
import pyarrow as pa

from adlens.llm import tiling

from .cases import empty, frame


def words(t):
    return re.findall(r"[^\W_]+|[^\x00-\x7f]+", (t or "").lower())


def brute(doc, item, k):
    """Marked item words: the longest common run of free words, again and again."""
    d, i = words(doc), words(item)
    used_d, used_i, total = [False] * len(d), [False] * len(i), 0
    while True:
        best = (0, 0, 0)
        for b in range(len(i)):
            for a in range(len(d)):
                n = 0
                while (a + n < len(d) and b + n < len(i) and d[a + n] == i[b + n]
                       and not used_d[a + n] and not used_i[b + n]):
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < k:
            return total
        used_d[a:a + n] = [True] * n
        used_i[b:b + n] = [True] * n
        total += n


def test_equals_plain_tiling(spark):
    rnd = random.Random(5)
    items = [(n, " ".join(f"t{rnd.randint(0, 40)}" for _ in range(rnd.randint(3, 40)))) for n in range(12)]
    docs = []
    for n in range(40):
        w = [f"z{rnd.randint(0, 30)}" for _ in range(30)]
        for _ in range(rnd.randint(0, 3)):
            src = items[rnd.randrange(12)][1].split()
            a = rnd.randrange(len(src))
            cut = src[a:a + rnd.randint(4, 20)]
            at = rnd.randrange(len(w))
            w[at:at] = cut
        docs.append((n, " ".join(w)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.matched_words for r in tiling.contaminated(d, b, 4, 0.2).collect()}
    want = {(i, j): m for i, t in docs for j, x in items
            if len(words(x)) >= 4 and (m := brute(t, x, 4)) >= 0.2 * len(words(x)) and m > 0}
    assert got == want and len(got) > 10


def test_reordered_passage_is_caught_and_spread_words_are_not(spark):
    item = " ".join(f"t{i}" for i in range(30))
    halves = " ".join(f"t{i}" for i in range(15, 30)) + " other words between, " + " ".join(f"T{i}!" for i in range(15))
    loose = " ".join(f"t{i} x{i}" for i in range(30))
    d = spark.createDataFrame([(1, halves), (2, loose), (3, item.upper() + " and more")], "doc_id long, text string")
    b = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.matched_words, r.n_tiles) for r in tiling.contaminated(d, b).collect())
    assert got == [(1, 7, 30, 2), (3, 7, 30, 1)]


def test_more_seeds_than_bits_of_the_map(spark, monkeypatch):
    monkeypatch.setattr(tiling, "MAP_BITS", 1 << 15)
    items = [(n, " ".join(f"t{n}x{i}" for i in range(2000))) for n in range(40)]
    docs = [(n, "x " + t) for n, t in items] + [(100, "nothing here at all to find")] * 2
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.item_id, r.matched_words) for r in tiling.contaminated(d, b).collect())
    assert got == [(n, n, 2000) for n in range(40)]


def test_equal_fingerprints_of_other_words_do_not_count(spark, monkeypatch):
    monkeypatch.setattr(tiling.Words, "windows", lambda self, m: np.zeros(max(0, len(self.hashes) - m + 1), np.uint64))
    item = " ".join(f"t{i}" for i in range(12))
    w = [tiling.Words(*tiling.tx.utf8(pa.array([t]))) for t in (item, "É x " + item.upper())]
    assert w[0].text(3, 5) == w[1].text(5, 5) == "t3 t4 t5 t6 t7"
    rows = spark.createDataFrame([(1, 2, item)], "doc_id long, row_key long, t string")
    assert {r.words for r in tiling.seeds(rows, 5).collect()} == {" ".join(f"t{j}" for j in range(i, i + 5)) for i in range(8)}


def test_windows_roll_and_words_agree_in_all_scripts():
    texts = ["the Quick brown-fox", "", "été ÉTÉ naïve", "a b 日本語 c d", "…", "the quick Brown fox é", "кот Кот 𝒳𝒴 𝒳𝒴"]
    w = tiling.Words(*tiling.tx.utf8(pa.array(texts)))
    assert w.first.tolist() == [0, 4, 4, 7, 14, 14, 19, 23]
    h = w.hashes
    assert h[4] == h[5] != h[6] and (h[:4] == h[14:18]).all() and h[19] == h[20] and h[21] == h[22]
    plain = tiling.Words(*tiling.tx.utf8(pa.array(texts[:2])))
    assert (plain.hashes == h[:4]).all()                                # bytes and code points agree
    assert [w.text(i, 1) for i in range(7, 14)] == ["a", "b", "日", "本", "語", "c", "d"]
    for m in (1, 3, 5):
        f = w.windows(m)
        for i in range(len(f)):
            total = 0
            for j in range(m):
                total += int(h[i + j]) * pow(int(tiling._BACK), j, 1 << 64)
            assert int(f[i]) == int(tiling.tx.mix(np.array([(total + m) % (1 << 64)], np.uint64))[0])


def test_awkward_rows(spark):
    df = frame(spark)
    b = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20))), (2, None), (3, ""), (4, "one two"),
                               (None, " ".join(f"w{i}" for i in range(30, 50))),
                               (1, " ".join(f"w{i}" for i in range(20)))], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.coverage) for r in tiling.contaminated(df, b).collect()), key=str)
    assert got == sorted(((d, i, 1.0) for d in (1, 2, 7, 8) for i in (1, None)), key=str)
    clash = tiling.decontaminate(df.withColumns({c: df.n for c in ("row_key", "_rk", "seed", "pos")}), b)
    own = {tuple(r[c] for c in ("row_key", "_rk", "seed", "pos")) for r in clash.collect()}  # _rk has a place in the frame already
    assert own <= {(1,) * 4, (None,) * 4} and clash.count() == df.count() - 4
    kept = tiling.decontaminate(df, b)
    assert kept.columns == df.columns and kept.count() == df.count() - 4
    assert tiling.contaminated(empty(spark), b).count() == 0
    assert tiling.decontaminate(df, b.limit(0)).count() == df.count()


def test_scripts_without_spaces_other_punctuation_and_short_items(spark):
    items = [(1, "北京是中国的首都。"), (2, "กรุงเทพเป็นเมืองหลวง"), (3, "“alpha beta”—gamma delta epsilon zeta"),
             (4, "two words"), (5, "one"), (6, "東京です"), (7, "??")]
    docs = [(1, "他说：北京是中国的首都，对吗？"), (2, "วันนี้กรุงเทพเป็นเมืองหลวงครับ"), (3, 'so "alpha\u00a0beta" - gamma delta epsilon zeta'),
            (4, "these Two, words! and two words"), (5, "twowords two of words"), (6, "首都東京です。"), (7, "one"), (8, "北京 首都 ??")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.coverage) for r in tiling.contaminated(d, b, short=True).collect())
    assert got == [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0), (4, 4, 1.0), (6, 6, 1.0), (7, 5, 1.0)]
    assert sorted(r.doc_id for r in tiling.decontaminate(d, b, short=True).collect()) == [5, 8]

"""Operators 6 and 7 against plain Python, and their plans."""

import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from adlens.llm import host_rules, shard_tree

from .cases import empty, frame, rows


def measure(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    twice = {g for g, n in Counter(wins).items() if n > 1}
    covered = {i + k for i, g in enumerate(wins) if g in twice for k in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_plain_python(spark):
    texts = [r[1] for r in rows()] + ["a b c d e a b c d e", "x " * 30, "l1\nl1\n \n \nl2\nl1", "# $% <b>|&* *", "a b c d e f a b c d e f g"]
    df = spark.createDataFrame([(n, t, "s") for n, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
           for r in host_rules.measures(df).collect()}
    assert got == {n: measure(t) for n, t in enumerate(texts)}


def test_hosts_are_shrunk_and_joined_back(spark):
    good = " ".join(f"g{i}" for i in range(20))
    data = [(n, "bad", "short") for n in range(95)] + [(n, "bad", good + f" {n}") for n in range(95, 100)]
    data += [(200 + n, "fine", good + f" {n}") for n in range(90)] + [(300 + n, "fine", "short") for n in range(10)]
    data += [(400, "tiny", "short"), (401, "tiny", good)] + [(500, None, good), (501, None, "short")]
    df = spark.createDataFrame(data, "doc_id long, source string, text string")
    got = {r.doc_id: r for r in host_rules.apply_host_rules(df).collect()}
    assert not any(got[n].kept for n in range(100))            # the host goes, good documents too
    assert all(got[200 + n].kept for n in range(90)) and not got[300].kept
    assert got[500].kept and not got[501].kept and got[500].host_rate is None
    rates = {r.host: r for r in host_rules.host_rates(df.select(
        F.col("source").alias("host"), (F.col("text") == "short").alias("failed"))).collect()}
    assert 0.9 < rates["bad"].host_rate < 0.95 and 0.1 < rates["fine"].host_rate < 0.2
    assert rates["tiny"].host_rate != 0.5


def test_every_rule_counts_against_the_host(spark):
    good = " ".join(f"word{i}" for i in range(20))
    bad = {"symbols": good + " # $ % &", "long": " ".join(f"averyverylongword{i}" for i in range(20)),
           "short": " ".join("abcdefghijklmnopqrst"), "lines": "\n".join([good, "again", "again", "again"])}
    data = [(n, name, f"{n} {t}") for name, t in bad.items() for n in range(60)]
    data += [(n, name, f"{good} {n}") for name in bad for n in range(60, 70)] + [(n, "fine", f"{good} {n}") for n in range(300)]
    data += [(n, "clean", f"# $ % {good}") for n in range(300, 310)] + [(n, "clean", f"{good} {n}") for n in range(310, 400)]
    got = host_rules.apply_host_rules(spark.createDataFrame(data, "doc_id long, source string, text string")).collect()
    assert not any(r.base_failed for r in got)                 # the base rules see nothing in any of them
    assert {(r.host, r.n_rules_failed) for r in got if r.doc_id < 60 and r.host != "fine"} == {(h, 1) for h in bad}
    assert {r.host for r in got if r.kept} == {"fine", "clean"}
    assert all(r.kept for r in got if r.host in ("fine", "clean"))  # symbols alone speak against the host only


def test_host_rules_awkward(spark):
    out = host_rules.apply_host_rules(frame(spark))
    assert out.count() == frame(spark).count()
    assert host_rules.apply_host_rules(empty(spark)).count() == 0


def test_shards_are_gapless_and_grow_into_the_new_one(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("é"), F.col("id")).alias("text"))
    out = shard_tree.shard_documents(df, shard_tree.tree(2, 2, 2), per_bucket=300).collect()
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.size == len(f"é{r.doc_id}".encode()) + 1 and r.text_crc32 == zlib.crc32(f"é{r.doc_id}".encode())
        assert r.grown_shard in (r.shard, 8)
    assert set(by) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert all(400 < len(s) < 600 for s in by.values())
    assert 330 < sum(r.grown_shard == 8 for r in out) < 560


def test_a_changed_weight_moves_keys_only_into_its_subtree(spark):
    old = shard_tree.tree(2, 2, 2)
    leaf = shard_tree.Node("s0", 3.0, (), 0)
    rack = shard_tree.branch("r0.k0", [leaf, old.children[0].children[0].children[1]])
    new = shard_tree.branch("top", [shard_tree.branch("r0", [rack, old.children[0].children[1]]), old.children[1]])
    key = F.col("id").cast("string")
    rows_ = spark.range(3000).select(shard_tree.descend(key, old).alias("a"), shard_tree.descend(key, new).alias("b")).collect()
    moved = [(r.a, r.b) for r in rows_ if r.a != r.b]
    assert moved and all(b < 4 for _, b in moved)              # into region 0 only
    assert all(b in (0, 1) for a, b in moved if a in (2, 3))   # within it, into rack 0 only
    assert all(b == 0 for a, b in moved if a == 1)             # within the rack, into shard 0 only


def test_shards_awkward(spark):
    df = frame(spark)
    out = shard_tree.shard_documents(df, shard_tree.tree(2, 2, 2), per_bucket=3).collect()
    assert len(out) == df.count()
    for s in {r.shard for r in out}:
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))
    assert [(r.size, r.text_crc32) for r in out if r.doc_id == 3] == [(1, 0)]
    assert shard_tree.shard_documents(empty(spark), shard_tree.tree(2, 2, 2)).count() == 0


def test_native_plans(spark):
    for df in (host_rules.apply_host_rules(frame(spark)), host_rules.measures(frame(spark)),
               shard_tree.shard_documents(frame(spark), shard_tree.tree(2, 2, 2))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

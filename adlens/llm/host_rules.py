"""Operator 6: quality rules with host verdicts (DataFrame functions only).

Each document is measured on its whole text. Documents that fail a rule (few or
repeated words, words too short or too long on average, many symbols, many
repeated lines) are counted by host, host failure rates are shrunk with a beta
prior whose two parameters are estimated from all hosts, and hosts with a high
shrunk rate are rejected: their documents go even if they pass the rules
themselves. A document of a good host goes by the base rules alone; the other
rules speak against its host only.

Defined results
---------------
* null text: counts as empty (0 words), so the base rules fail, and no other one.
* empty table: empty result; no prior is needed.
* null host: the document belongs to no host; only its own rules count.
* repeated rows: each row counts once in its host and is returned once.
* very long text: the whole text is measured; one row is never split.
* extra or clashing columns of the input are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import saved
from .text import SPACES

WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Mean code points of a word, from and to (two: some languages write syllables apart); symbols in 100 words; repeated lines in 100 lines.
WORD_CHARS = (2, 10)
SYMBOL_PERCENT = 10
DUP_LINE_PERCENT = 30


def measures(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: id, host, n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words.

    The steps are separate projections because each array is read by several
    expressions of the next one, so Spark keeps it as a column and lambdas see
    a column, never an expression to evaluate again per element.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = docs.select(F.col(id).alias("doc_id"), F.col(host).alias("host"), body.alias("t"))
    df = df.select(
        "doc_id", "host", F.filter(F.split("t", SPACES), lambda w: w != "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.length(F.regexp_replace("t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"))
    last = F.size("w") - (WINDOW - 1)
    df = df.select(
        "doc_id", "host", "word_chars", "n_symbols", F.size("w").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                                      lambda i: F.xxhash64(F.slice(F.col("w"), i, WINDOW))))
        .otherwise(F.array().cast("array<bigint>")).alias("h"))
    df = df.select(
        "doc_id", "host", "word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines",
        F.when(F.size("h") > F.size(F.array_distinct("h")),
               F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("s"))

    def at(k: Column) -> Column:
        return F.get(F.col("s"), k)["x"]

    again = F.filter(F.sequence(F.lit(0), F.size("s") - 1),
                     lambda k: at(k).eqNullSafe(at(k - 1)) | at(k).eqNullSafe(at(k + 1)))
    df = df.select(
        "doc_id", "host", "word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines",
        F.when(F.col("s").isNotNull(),
               F.sort_array(F.transform(again, lambda k: F.get(F.col("s"), k)["i"]))).alias("p"))
    covered = F.aggregate(
        "p", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, x: F.struct((a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n"), x.alias("last")),
        lambda a: a["n"])
    return df.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                     F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    """Fewer than 10 words, or over 20 % of the words in repeated 5-word windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rules() -> list[Column]:
    """Whether each rule fails; the base rules count as one."""
    shortest, longest = WORD_CHARS
    return [base_failed(),
            (F.col("word_chars") < shortest * F.col("n_words")) | (F.col("word_chars") > longest * F.col("n_words")),
            100 * F.col("n_symbols") > SYMBOL_PERCENT * F.col("n_words"),
            100 * F.col("n_dup_lines") > DUP_LINE_PERCENT * F.col("n_lines")]


def host_rates(rows: DataFrame, min_strength: float = 2.0, max_strength: float = 1e6) -> DataFrame:
    """Failure rate of each host, shrunk to the beta prior fitted on all hosts.

    ``rows`` has host and failed (boolean). The prior's mean is the overall
    rate; its strength comes from the spread of the host rates beyond binomial
    noise (method of moments, weighted by documents). Hosts are pre-aggregated
    before the shuffle; only one row (the prior's sums) reaches the driver.
    """
    hosts = saved(rows.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")), "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    sums = hosts.agg(F.count("*").alias("h"), F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"),
                     F.sum(F.col("n_docs") * rate * rate).alias("rr")).first()
    mean, strength = 0.0, max_strength
    if sums["h"]:
        mean = sums["f"] / sums["n"]
        noise = mean * (1 - mean)
        spread = max(sums["rr"] / sums["n"] - mean * mean, 0.0) - noise * sums["h"] / sums["n"]
        if spread > 0:
            strength = min(max(noise / spread - 1, min_strength), max_strength)
    return hosts.select("host", "n_docs", "n_failed",
                        ((F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength)))
                        .alias("host_rate"))


def apply_host_rules(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source",
                     max_rate: float = 0.5) -> DataFrame:
    """Measures, base_failed, n_rules_failed, host_rate and kept of every document.

    A document is kept if it passes the base rules and its host's shrunk rate
    of documents that fail any rule is at most ``max_rate``.
    """
    failed = sum((r.cast("long") for r in rules()), F.lit(0))
    rows = saved(measures(docs, id, text, host).withColumn("base_failed", base_failed())
                 .withColumn("n_rules_failed", failed.cast("long")), "measures")
    rates = saved(host_rates(rows.select("host", (F.col("n_rules_failed") > 0).alias("failed"))), "host_rates")
    good = ~F.col("base_failed") & (F.coalesce(F.col("host_rate"), F.lit(0.0)) <= max_rate)
    return rows.join(rates.select("host", "host_rate"), "host", "left").withColumn("kept", good)

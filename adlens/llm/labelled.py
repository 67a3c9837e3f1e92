"""All labelled texts in parts, and models that are fitted on every part and averaged.

A model is two matrices with rows of ``WIDE`` numbers: its values and the sums
of squared gradients of each value (adaptive step sizes). In every round each
part is learned by one task from the same model, text after text; the changes
of a row are then averaged over the parts that changed it. The matrices have
a fixed size, so what reaches the driver does not grow with the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.session import isolated

from .idmap import marked
from .store import saved

WIDE = 16
#: Text of one part, about.
PART_BYTES = 32 << 20
#: A file is read by one task, so that a part is.
WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": "1t", "spark.sql.files.openCostInBytes": "1t"}


def labelled_parts(docs: DataFrame, labels: DataFrame, y: str, id: str = "doc_id", text: str = "text",
                   part_bytes: int = PART_BYTES, lang: str | None = None) -> DataFrame:
    """(part, check, i, t, y), and lang where it is named: every labelled text, whole, stored by parts.

    The part, the order within it and ``check`` (a quarter) follow from the
    id's hash, not from the order or the partitioning of the input. An id
    labelled twice counts with its larger label, one with two languages with the larger one.
    """
    known = saved(labels.where(F.col(y).isNotNull() & F.col(id).isNotNull()).groupBy(F.col(id).alias("i"))
                  .agg(F.max(y).alias("y")), "known")
    texts = docs.select(F.col(id).alias("i"), F.col(text).cast("string").alias("t")).where("t is not null")
    texts = marked(texts, "i", known.select("i"))
    if lang is not None:
        tongues = docs.select(F.col(id).alias("i"), F.col(lang).cast("string").alias("lang")).where("lang is not null")
        known = known.join(tongues.groupBy("i").agg(F.max("lang").alias("lang")), "i", "left")
    told = known.columns[1:]
    parts = 1 + (texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // part_bytes
    key = lambda use: F.xxhash64("i", F.lit(use))
    # Texts move once: they and what is known of them go to their part together and meet there.
    both = texts.unionByName(known, allowMissingColumns=True).withColumn("ord", key("order")).withColumn(
        "part", F.pmod(key("part"), F.lit(parts)).cast("int")).repartition(parts, "part")
    same = Window.partitionBy("part", "ord", "i")
    rows = both.select("part", (F.pmod(key("check"), F.lit(4)) == 0).alias("check"), "ord", "i", "t",
                       *[F.max(c).over(same).alias(c) for c in told])
    return saved(rows.where("t is not null and y is not null").sortWithinPartitions("part", "ord", "i", "t").drop("ord"),
                 "labelled", read=WHOLE_FILES)


def by_part(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """(part, its rows) of a task's rows, which stand by parts."""
    def pieces():
        for b in batches:
            p = b.column("part").to_numpy()
            edge = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])) if len(p) else []
            for a, z in zip(edge, [*edge[1:], len(p)]):
                yield int(p[a]), b.slice(a, z - a)

    for part, own in groupby(pieces(), key=lambda x: x[0]):
        yield part, (b for _, b in own)


def averaged(rows: DataFrame, values: np.ndarray, seen: np.ndarray, learn: Callable, rounds: int) -> None:
    """Changes ``values`` and ``seen`` by ``rounds`` rounds over ``rows`` (``labelled_parts``).

    ``learn(values, seen, batches, seed)`` does so for one part with copies of them.
    """
    names = [f"{c}{j}" for c in "vs" for j in range(WIDE)]
    schema = "k int, " + ", ".join(f"{n} float" for n in names)
    for r in range(rounds):
        sent = rows.sparkSession.sparkContext.broadcast((values, seen))

        def run(batches: Iterable[pa.RecordBatch], r=r, sent=sent) -> Iterator[pa.RecordBatch]:
            for part, own in by_part(batches):
                old = sent.value
                new = [x.copy() for x in old]
                learn(*new, own, (r, part))
                k = np.flatnonzero(((new[0] != old[0]) | (new[1] != old[1])).any(axis=1))
                for a in range(0, len(k), 10_000):
                    some = k[a:a + 10_000]
                    d = [(n[some] - o[some]).astype(np.float32) for n, o in zip(new, old)]
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *[pa.array(np.ascontiguousarray(x[:, j]))
                                                                                    for x in d for j in range(WIDE)]],
                                                     names=["k", *names])

        got = rows.mapInArrow(run, schema).groupBy("k").agg(
            *[(F.sum(n) / F.count(F.lit(1))).cast("float").alias(n) for n in names]).toArrow()
        k = got["k"].to_numpy()
        for c, x in zip("vs", (values, seen)):
            for j in range(WIDE):
                x[k, j] += got[f"{c}{j}"].to_numpy()
        sent.unpersist()

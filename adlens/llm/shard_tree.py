"""Operator 7: sharding by a weighted hash tree (DataFrame functions only).

A tree has regions, racks and shards, each shard with a weight. A key descends
from the top: at each level every child draws ``-ln(u) / weight`` with ``u``
from a hash of (key, child name), and the smallest draw wins. A draw depends
only on the key, the child's name and its weight, so a change of weights moves
keys only into or out of the subtrees whose weights changed.

Defined results
---------------
* null key: hashed as its own fixed key; null text: 0 bytes, size 1, CRC 0.
* empty table: empty result.
* repeated rows: each gets its own slot; ties are equal rows, so any order of
  them gives the same result.
* one key or one row holding a large part of the input: equal rows are counted
  before the shuffle and numbered as one block, expanded at the end.
* extra or clashing columns of the input are not carried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import saved


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; a shard has a number and no children."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None


def branch(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def tree(regions: int = 2, racks: int = 2, shards: int = 2) -> Node:
    """Equal weights; shards are numbered in order of region, rack, place."""
    number, top = 0, []
    for r in range(regions):
        level = []
        for k in range(racks):
            leaves = []
            for _ in range(shards):
                leaves.append(Node(f"s{number}", 1.0, (), number))
                number += 1
            level.append(branch(f"r{r}.k{k}", leaves))
        top.append(branch(f"r{r}", level))
    return branch("top", top)


def grown(top: Node) -> Node:
    """The tree with one more shard, in a region of its own.

    No other subtree's weight changes, so rows move only into the new shard.
    """
    number = leaves(top)
    r = f"r{len(top.children)}"
    return branch("top", [*top.children, branch(r, [branch(f"{r}.k0", [Node(f"s{number}", 1.0, (), number)])])])


def leaves(node: Node) -> int:
    return sum(map(leaves, node.children)) if node.children else 1


def uniform(key: Column, name: str) -> Column:
    """A number in (0, 1) from the first 52 bits of md5(key/name)."""
    top = F.conv(F.substring(F.md5(F.concat(key, F.lit("/" + name))), 1, 13), 16, 10).cast("long")
    return (top + F.lit(0.5)) / F.lit(float(1 << 52))


def descend(key: Column, node: Node) -> Column:
    """Shard number of ``key`` below ``node``."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return descend(key, node.children[0])
    best = F.array_min(F.array(*[F.struct((-F.log(uniform(key, c.name)) / F.lit(c.weight)).alias("draw"),
                                          F.lit(i).alias("i")) for i, c in enumerate(node.children)]))["i"]
    where = F.when(best == 0, descend(key, node.children[0]))
    for i, c in enumerate(node.children[1:], 1):
        where = where.when(best == i, descend(key, c))
    return where


def slots(rows: DataFrame, order: Column, per_bucket: int = 100_000) -> DataFrame:
    """Gapless ``slot`` from 0 within each ``shard``, in the order of ``order``
    (a hash in [0, 1) as a double) and then of all columns.

    Equal rows are counted first. Rows are numbered within (shard, bucket of
    the hash) and shifted by the counts of the shard's earlier buckets, so no
    task sees a whole shard. Buckets follow the row count.
    """
    cols = rows.columns
    groups = saved(rows.groupBy(*cols).agg(F.count("*").alias("_m")), "shard_rows")
    total = groups.agg(F.sum("_m")).first()[0] or 0
    n = max(1, -(-total // per_bucket))
    placed = groups.withColumn("_o", order).withColumn("_b", F.floor(F.col("_o") * n))
    sizes = placed.groupBy("shard", "_b").agg(F.sum("_m").alias("_k"))
    before = Window.partitionBy("shard").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_b", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_start"))
    within = (Window.partitionBy("shard", "_b").orderBy("_o", *cols)
              .rowsBetween(Window.unboundedPreceding, -1))
    first = F.col("_start") + F.coalesce(F.sum("_m").over(within), F.lit(0))
    return (placed.join(starts, ["shard", "_b"]).withColumn("_first", first)
            .select(*cols, F.explode(F.sequence("_first", F.col("_first") + F.col("_m") - 1)).alias("slot")))


def shard_documents(docs: DataFrame, top: Node, id: str = "doc_id", text: str = "text",
                    per_bucket: int = 100_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    key = F.coalesce(F.col(id).cast("string"), F.lit("null"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"), key.alias("_key"))
    rows = rows.select("doc_id", "size", "text_crc32", descend(F.col("_key"), top).cast("int").alias("shard"),
                       descend(F.col("_key"), grown(top)).cast("int").alias("grown_shard"))
    order = uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "slot")
    return slots(rows, order, per_bucket).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")

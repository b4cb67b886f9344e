"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child draws ``-ln(u) / weight`` with ``u``
a hash of (doc_id, child) and the smallest draw wins, so a child gets its share of the weight, and a
changed weight moves rows only into or out of the subtree whose weight changed: the draws of all other
children stay as they were.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import running_total

OVERHEAD = 8  # bytes a row takes besides its text


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(shards: int, base: int = 24, racks: int = 3, per_rack: int = 4) -> list[Leaf]:
    """The tree of ``shards`` equal shards: racks of ``per_rack`` in regions of ``racks``.

    Shards beyond ``base`` were added later, each as a region of its own. No weight below another
    region changes then, so rows move from old shards into the new one and nowhere else.
    """
    rooted = min(shards, base)
    leaves = [Leaf(s // (racks * per_rack), s // per_rack, s) for s in range(rooted)]
    regions = -(-base // (racks * per_rack))
    return leaves + [Leaf(regions + s - base, -(-base // per_rack) + s - base, s) for s in range(rooted, shards)]


def draw(key: Column, level: str, child: Column, weight: Column) -> Column:
    """-ln(u) / weight; u has 52 bits of an md5 and is never 0 or 1."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"|{level}|"), child.cast("string"))), 1, 13), 16, 10).cast("double")
    return -F.log((bits + F.lit(0.5)) / F.lit(2.0**52)) / weight


def children(leaves: list[Leaf], parent: str | None, child: str) -> dict[int, dict[int, float]]:
    """By parent number (0 where there is none) the weights of its children."""
    out: dict[int, dict[int, float]] = {}
    for leaf in leaves:
        if leaf.weight > 0:
            inside = out.setdefault(getattr(leaf, parent) if parent else 0, {})
            inside[getattr(leaf, child)] = inside.get(getattr(leaf, child), 0.0) + leaf.weight
    return out


def descend(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of ``key``: the child with the smallest draw, level by level. Ties go to the lower number."""

    def pick(at: Column, parent: str | None, child: str) -> Column:
        tree = children(leaves, parent, child)
        nodes = [F.array(*[F.struct(F.lit(c).alias("c"), F.lit(w).alias("w")) for c, w in sorted(tree.get(p, {}).items())]) if p in tree
                 else F.array().cast("array<struct<c:int,w:double>>") for p in range(max(tree) + 1)]
        drawn = F.transform(F.get(F.array(*nodes), at), lambda x: F.struct(draw(key, child, x["c"], x["w"]).alias("d"), x["c"].alias("c")))
        return F.array_min(drawn)["c"]

    return pick(pick(pick(F.lit(0), None, "region"), "region", "rack"), "rack", "shard")


def shard_documents(docs: DataFrame, shards: int = 24, leaves: list[Leaf] | None = None, grown: list[Leaf] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    The law is ``key``: doc_id and the tree alone decide. A null doc_id is a key of its own; a null text
    has size 8 and the checksum of no bytes. Rows with one doc_id share a shard, whatever their text;
    equal rows take slots of their own. ``slot`` numbers a shard's rows from 0 in an order of hashes; it
    comes from one range-partitioned running count, so no shard is ever held by one task. Other columns
    are not read. An empty table gives an empty result.
    """
    leaves, grown = leaves or layout(shards), grown or layout(shards + 1)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        descend(key, leaves).alias("shard"),
        descend(key, grown).alias("grown_shard"),
        F.xxhash64(key).alias("spread"),
    )
    rows = running_total(rows.withColumn("one", F.lit(1)), ["shard", "spread", "doc_id", "text_crc32", "size"], "one")
    first = rows.groupBy("shard").agg(F.min("seq").alias("first"))  # one row a shard
    return rows.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("seq") - F.col("first")).alias("slot"), "grown_shard"
    )

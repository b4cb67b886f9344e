"""Helpers the operators of this package share: scratch tables, running totals, components."""

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ratelens.session import shared_folder

#: What parts words in every operator but decontamination: space, tab to carriage return.
SPACES = "[ \\x09-\\x0D]+"
#: A side is broadcast only below this many rows (each of a bounded width).
BROADCAST_ROWS = 500_000
#: Earlier lists of a node that an entry carries.
CARRIED = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``; a temporary one only where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="ratelens-llm-")
    return os.path.join(shared_folder(spark, base) if base else base, f"llm-{uuid.uuid4().hex}")


def staged(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when it has at most ``rows`` rows, else unchanged (a shuffled join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def with_ids_as_text(df: DataFrame, run: Callable, schema: str, *ids: str) -> DataFrame:
    """``df.mapInPandas(run, schema)``; the columns ``ids`` pass as text, as pandas has no exact long with nulls."""
    types = {c: df.schema[c].dataType for c in ids}
    out = df.withColumns({c: F.col(c).cast("string") for c in ids}).mapInPandas(run, schema)
    return out.withColumns({c: F.col(c).cast(types[c]) for c in ids})


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often ``use`` or an inner lambda names it.

    A plain column is put in place wherever it is used when a filter moves below the projection that made it.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def running_total(df: DataFrame, order: list, value: str) -> DataFrame:
    """``df`` with ``seq`` (rows before, from 0) and ``upto`` (sum of ``value`` up to and with the row).

    One range partitioning by ``order`` and a sum within each partition; the partitions' totals, one
    row a partition, give the offsets. No task holds more than its range. ``order`` must tell all
    rows apart but those that are equal throughout.
    """
    out = T.StructType(df.schema.fields + [T.StructField(c, T.LongType()) for c in ("seq", "upto", "part")])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = pc.add(pc.cumulative_sum(batch.column(value).cast(pa.int64())), total)
            seq = pa.array(range(rows, rows + batch.num_rows), pa.int64())
            rows, total = rows + batch.num_rows, sums[-1].as_py()
            extra = [seq, sums, pa.array([part] * batch.num_rows, pa.int64())]
            yield pa.RecordBatch.from_arrays(batch.columns + extra, names=[*batch.schema.names, "seq", "upto", "part"])

    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = staged(ranged.mapInArrow(within, out))
    parts = rows.groupBy("part").agg(F.count("*").alias("n"), F.max("upto").alias("s"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    parts = parts.select(
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s0"),
    )
    return (
        rows.join(F.broadcast(parts), "part")  # as many rows as there are shuffle partitions
        .withColumns({"seq": F.col("seq") + F.col("n0"), "upto": F.col("upto") + F.col("s0")})
        .drop("part", "n0", "s0")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b: long): comp is the smallest node it reaches.

    Alternating large and small stars; every round is a few aggregations and joins, written out.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        joined = both.join(least, "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            )
        return out.where("a <> b").distinct()

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    pairs = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = mark(pairs)
    while seen[0]:
        pairs = staged(star(star(pairs, True), False))
        now = mark(pairs)
        if now == seen:
            break
        seen = now
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    )


def merged(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """``groups`` (node, comp) after ``edges`` (a, b) between their nodes or new ones; comp stays the smallest node."""
    for end in ("a", "b"):
        known = groups.select(F.col("node").alias(end), F.col("comp").alias(f"{end}_comp"))
        edges = edges.join(known, end, "left").withColumn(end, F.coalesce(f"{end}_comp", end)).drop(f"{end}_comp")
    roots = components(edges.where("a <> b"))
    moved = roots.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
    kept = groups.join(moved, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp"))
    return kept.unionByName(roots.join(groups.select("node"), "node", "left_anti"))


def linked_groups(lists: DataFrame, verified: Callable[[DataFrame], DataFrame], possible: Callable[[str, str], str] | None = None, order: str = "0", stars: tuple = (1, 8)) -> DataFrame:
    """(node, comp) of the graph whose links are the pairs that share a list and that ``verified`` keeps.

    ``lists`` has (key, node) and, with ``possible``, info: a condition on the infos of two entries of a list that
    a link may not fail in the first list it shares by ``order`` (SQL on an entry; the same order of lists for all
    nodes, then by key). A pair that fails it is not made. ``verified`` takes (a, b)
    and returns those that are links. A list is first compared with a few of its members, the hubs, only
    (``stars``: how many in each round at most): what is linked with a hub has its answer from the hub's and needs
    no further comparison with others that have it too. A list whose members are in one group is done. After
    these rounds, what is left is compared pair by pair, but only across groups. So no link between groups is
    lost, and no group of copies is paired out. Each round joins the groups of the one before, not their members
    anew.
    """
    if possible is None:
        lists, possible = lists.withColumn("info", F.lit(0)), lambda x, y: "true"
    todo, groups = lists, None
    for turn in range(len(stars) + 1):
        if groups is not None:
            known = todo.join(groups, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
            open_ = known.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
            todo = staged(known.join(open_, "key"))
        else:
            todo = todo.withColumn("comp", F.col("node"))
        if turn and todo.isEmpty():
            break
        one = todo.select("key", F.col("node").alias("x"), F.col("info").alias("x_info"), "comp")
        if turn < len(stars):
            slot = F.pmod(F.xxhash64("node", F.lit(-1 - turn)), F.lit(stars[turn]))
            hub = F.min_by(F.struct("node", "comp", "info"), F.xxhash64("node", F.lit(turn))).alias("hub")
            other = todo.groupBy("key", slot).agg(hub).select("key", F.col("hub.node").alias("y"), F.col("hub.info").alias("y_info"), F.col("hub.comp").alias("c"))
            across = "comp <> c"
        else:
            # A pair is made in the first list that the two share, as far as the lists a node comes from are carried.
            places = todo.groupBy("node", "comp").agg(F.sort_array(F.collect_list(F.struct(F.expr(order).alias("o"), "key", "info"))).alias("all"))
            each = places.select("node", "comp", "all", F.posexplode("all").alias("at", "own"))
            each = each.select("node", "comp", "own.key", "own.info", F.expr(f"slice(all.key, greatest(at - {CARRIED - 1}, 1), least(at, {CARRIED}))").alias("before"))
            todo = staged(each)
            one = todo.select("key", F.col("node").alias("x"), F.col("info").alias("x_info"), "comp", "before")
            other = todo.select("key", F.col("node").alias("y"), F.col("info").alias("y_info"), F.col("comp").alias("c"), F.col("before").alias("y_before"))
            across = "comp < c"
            made = possible
            possible = lambda x, y: f"{made(x, y)} and not arrays_overlap(before, y_before)"
        pairs = one.alias("l").join(other.alias("r"), (F.col("l.key") == F.col("r.key")) & F.expr(across) & F.expr(possible("x_info", "y_info")))
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        found = staged(verified(staged(pairs)))
        groups = staged(components(found) if groups is None else merged(groups, found))
        todo = todo.select("key", "node", "info")
    return groups

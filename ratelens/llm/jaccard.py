"""Exact n-gram Jaccard join by set relations.

A set's shingles stand in one order for all sets, rare ones first. Two linked sets have a common shingle among the
first few of each (the prefix), so only prefixes are indexed: a list holds, for one shingle, the sets that have it
there, each with its size, the shingle's position and a sketch of the set. Lists are cut into blocks by size, and a
set is met by the blocks it can be linked with only; within a block, position and sketch bound the overlap of two
sets before they become a pair. Equal sets are one class. In a block, sets are compared with one hub; a set
that is linked with the hub takes its answer (the group) from the hub's, and only sets that no hub answers are
compared further, and only across groups. No link between different sets is lost, and groups of copies are
not paired out.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import linked_groups, small, staged
from ratelens.llm.hashing import grouped_texts, shingles_of

WIDTH, PERCENT = 4, 85
#: Sizes of a block differ by this factor at most.
CLASS = 0.7
#: Shingles are counted in so many cells, which order them; a cell's count is that of all shingles in it.
CELLS, PARTS = 1 << 22, 64
#: Bits of a sketch: the parity of the number of shingles that fall on each.
SKETCH = 512


def class_tops(size: int) -> list[int]:
    tops = [4]
    while tops[-1] < size:
        tops.append(max(tops[-1] + 1, int(tops[-1] / CLASS)))
    return tops


def classes(size: int, percent: int = PERCENT) -> list[int]:
    """The blocks by size in which a set stands: its own, and the one below if a set of it can be linked with it.

    Two linked sets share the block of the smaller one.
    """
    tops = class_tops(size)
    own = len(tops) - 1
    return [own - 1, own] if own and size * percent <= 100 * tops[own - 1] else [own]


def prefix(size: int, percent: int = PERCENT) -> int:
    """How many shingles of a set are indexed: without them, fewer are left than any linked set must share."""
    return size - -(-percent * size // 100) + 1


def ordered(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The sorted ``hashes`` with those of frequent cells after those of rarer ones."""
    level = levels[hashes & np.uint64(CELLS - 1)]
    return hashes[np.argsort(level, kind="stable")] if level.any() else hashes


def sketch(hashes: np.ndarray, bits: int = SKETCH) -> np.ndarray:
    """Parities as longs: two sets differ in as many shingles at least as their sketches differ in bits."""
    places = (hashes >> np.uint64(22)).astype(np.int64) & (bits - 1)
    return np.packbits(np.bincount(places, minlength=bits).astype(np.uint8) & 1, bitorder="little").view(np.int64)


def wide(hashes: np.ndarray) -> bytes:
    """A sketch of two bits a shingle and more; its halves' difference is the sketch of half the bits."""
    return sketch(hashes, max(SKETCH, 1 << (2 * len(hashes) - 1).bit_length())).tobytes()


def apart(x: bytes, y: bytes) -> int:
    """Bits in which two wide sketches differ, the wider one folded."""
    a, b = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def each_set(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """(batch, row in it, sorted distinct shingles) of every row."""
    for batch in batches:
        for row, offsets, data in grouped_texts(batch.column("text")):
            bounds, hashes = shingles_of(offsets, data, width)
            for r in range(len(offsets) - 1):
                yield batch, row + r, hashes[bounds[r] : bounds[r + 1]]


def frequencies(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    """A level for every cell: 0 for cells of a usual count, else higher with the logarithm of the count.

    All shingles of all documents are counted. Tasks hand on their counts in PARTS pieces, which are added
    up by piece; the driver gets one byte a cell. The level orders shingles; whatever it is, no link is lost.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(CELLS, np.uint32)
        for batch in batches:
            for _, offsets, data in grouped_texts(batch.column("text")):
                count += np.bincount(shingles_of(offsets, data, width)[1] & np.uint64(CELLS - 1), minlength=CELLS).astype(np.uint32)
        pieces = [zlib.compress(c.astype(np.int64).tobytes(), 1) for c in np.split(count, PARTS)]
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([task % 64] * PARTS, pa.int32()), pa.array(pieces)], names=["part", "task", "counts"])

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in rows["counts"])
        return pd.DataFrame({"part": rows["part"][:1], "task": rows["task"][:1], "counts": [zlib.compress(total.tobytes(), 1)]})

    counts = docs.select("text").mapInArrow(run, "part int, task int, counts binary")
    for by in (["part", "task"], ["part"]):  # in two steps, so that no group has a row of every task
        counts = counts.groupBy(*by).applyInPandas(added, counts.schema)
    return levels_of({r.part: r.counts for r in counts.collect()})  # PARTS rows


def levels_of(counts: dict[int, bytes]) -> np.ndarray:
    """The levels, one byte a cell, from the compressed counts of each piece.

    Opened piece by piece: the driver never holds the counts of all cells, nor what is made of them on the way.
    """
    levels = np.zeros(CELLS, np.uint8)
    mean = sum(int(np.frombuffer(zlib.decompress(c), np.int64).sum()) for c in counts.values()) / CELLS
    usual = mean + 6 * np.sqrt(mean) + 8  # beyond the chance sum of rare shingles in one cell
    for piece, own in zip(range(PARTS), np.split(levels, PARTS), strict=True):
        if piece in counts:
            count = np.frombuffer(zlib.decompress(counts[piece]), np.int64)
            own[:] = np.where(count <= usual, 0, 1 + np.log2(np.maximum(count / usual, 1))).astype(np.uint8)
    return levels


def sets(docs: DataFrame, shared, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(row, n_shingles, signature, prefix, sketch, wide): one row a document; the last three once a task for equal sets.

    ``docs`` has row and text, ``shared`` the broadcast levels. The signature has 128 bits; null without words.
    """
    fields = [("row", pa.int64()), ("n_shingles", pa.int64()), ("signature", pa.binary()), ("prefix", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())), ("wide", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        rows: list[tuple] = []
        for batch, at, found in each_set(batches, width):
            node, first, bits = xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None, [], []
            far = b""
            if node is not None and node not in seen:
                first = ordered(found, shared.value)[: prefix(len(found), percent)].view(np.int64)
                bits, far = sketch(found), wide(found)
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(node)
            rows.append((batch.column("row")[at].as_py(), len(found), node, first, bits, far))
            if len(rows) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])

    return docs.select("row", "text").mapInArrow(run, "row long, n_shingles long, signature binary, prefix array<long>, sketch array<long>, wide binary")


def members(docs: DataFrame, nodes: DataFrame, width: int = WIDTH) -> DataFrame:
    """(node, shingles) of ``nodes`` (row, node): the hashes as bytes, built anew from the texts of these rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch, at, found in each_set(batches, width):
            rows.append((batch.column("node")[at].as_py(), found.tobytes()))
            if len(rows) >= 200:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["node", "shingles"])
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["node", "shingles"])

    wanted = docs.select("row", "text").join(small(nodes.select(F.col("node").alias("row"))), "row", "left_semi")
    return staged(wanted.select(F.col("row").alias("node"), "text").mapInArrow(run, "node long, shingles binary"), "none")


def possible(percent: int = PERCENT):
    """SQL on the infos of two entries of a list that linked sets pass where their first common shingle is.

    Their sizes, what the positions leave for the overlap, and the sketches' distance, which differing
    shingles bound from above.
    """

    def condition(x: str, y: str) -> str:
        both = f"({x}.size + {y}.size)"
        bits = " + ".join(f"bit_count({x}.sketch[{k}] ^ {y}.sketch[{k}])" for k in range(SKETCH // 64))
        return (
            f"100 * least({x}.size, {y}.size) >= {percent} * greatest({x}.size, {y}.size)"
            f" and {100 + percent} * least({x}.size - {x}.pos, {y}.size - {y}.pos) >= {percent} * {both}"
            f" and {100 + percent} * ({bits}) <= {100 - percent} * {both}"
        )

    return condition


def near(pairs: DataFrame, one: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``pairs`` (a, b) without those whose wide sketches tell that they differ in too many shingles."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            most = (100 - percent) * (batch["m"] + batch["n"]) // (100 + percent)
            yield batch.loc[[apart(x, y) <= d for x, y, d in zip(batch["x"], batch["y"], most, strict=True)], ["a", "b"]]

    left = one.select(F.col("node").alias("a"), F.col("size").alias("m"), F.col("wide").alias("x"))
    right = one.select(F.col("node").alias("b"), F.col("size").alias("n"), F.col("wide").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "m", "n", "x", "y").mapInPandas(run, "a long, b long")


def similar(pairs: DataFrame, docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Those of ``pairs`` (a, b: rows of ``docs``) whose sets have the similarity. Only sets of pairs are built."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                left, right = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([left, right])
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.loc[keep, ["a", "b"]]

    found = members(docs, staged(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()), width)
    left = found.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = found.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(run, "a long, b long")


def grouped(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """row, n_shingles, node, component of every row of ``docs`` (row: a long that tells rows apart, text).

    ``component`` is null for a document without words, which is linked with nothing; rows with equal
    shingle sets have one node, the smallest row. A null text has no words. Shingles are compared by 64-bit
    hashes, whole sets by 128 bits. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequencies(docs, width))  # CELLS bytes
    rows = staged(sets(docs, shared, width, percent))
    nodes = rows.where("signature is not null").groupBy("signature").agg(F.min("row").alias("node"), F.count("*").alias("copies"))
    known = staged(rows.select("row", "n_shingles", "signature").join(nodes, "signature", "left").select("row", "n_shingles", "node"))
    one = rows.join(known.where("row = node").select("row"), "row").withColumnRenamed("row", "node")
    one = staged(one.select("node", F.col("n_shingles").cast("int").alias("size"), "prefix", "sketch", "wide"), "zstd")
    # One exchange serves the aggregation and the join; a hot key's rows stream through both.
    entries = one.select("node", "size", F.posexplode("prefix").alias("pos", "token")).repartition("token")
    each = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"print{k}") for k in range(2)]
    lists = entries.groupBy("token").agg(F.count("*").alias("n"), F.sum("pos").alias("at"), *each).where("n > 1")
    # Of lists with the same sets the first in order serves: a pair's first common shingle is never that of another.
    first = lists.groupBy("n", "print0", "print1").agg(F.min(F.struct("at", "token")).alias("first")).select("first.token")
    entries = staged(entries.join(first, "token"))
    stands = F.udf(lambda size: classes(size, percent), "array<int>")
    sizes = staged(entries.select("size").distinct().withColumn("classes", stands("size")))  # a row a size
    info = F.struct("size", "pos", "sketch").alias("info")
    blocks = entries.join(small(sizes), "size").select("node", "size", "pos", F.explode("classes").alias("class"), "token")
    lists = staged(blocks.join(one.select("node", "sketch"), "node").select(F.xxhash64("token", "class").alias("key"), "node", info))
    groups = linked_groups(lists, lambda pairs: similar(staged(near(pairs, one, percent)), docs, width, percent), possible(percent), "info.pos")
    out = known.join(groups.withColumnRenamed("comp", "component"), "node", "left")
    return out.withColumn("component", F.coalesce("component", "node")).select("row", "n_shingles", "node", "component")


def numbered(docs: DataFrame) -> DataFrame:
    """A written copy of ``docs`` with a number ``row``, so that equal rows and ids are told apart."""
    return staged(docs.withColumn("row", F.monotonically_increasing_id()), "zstd")


def components_of(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable, null where all are null).

    A document without words is its own component. Ids may be null or repeated. See ``grouped``.
    """
    marked = numbered(docs.select("doc_id", "text"))
    rows = staged(grouped(marked).join(marked.select("row", "doc_id"), "row"))
    least = rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )


def survivors(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group, that of the smallest doc_id (null first), and all rows without words."""
    marked = numbered(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")))
    rows = staged(grouped(marked.select("row", F.col("document.text").alias("text"))).select("row", "component"))
    known = rows.where("component is not null").join(marked.select("row", "document.doc_id"), "row")
    first = known.groupBy("component").agg(F.min(F.struct("doc_id", "row")).alias("first")).select("first.row")
    kept = first.unionByName(rows.where("component is null").select("row"))
    return marked.join(kept, "row", "left_semi").select("document.*")

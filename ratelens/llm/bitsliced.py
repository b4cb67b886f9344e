"""Exact top-k inner products over a bit-sliced index.

Rows stand in blocks. In a block every quantised component, less the block's smallest, is cut into its bits, and
the bits of one place of all rows make a bitmap, a slice. A query's scores are the sum of its own component's bits
times slices, of the slices' complements where the query's component is negative. That sum is taken by full
adders over whole bitmaps, and its result is slices again. The best rows are found from the most significant of
them downward; rows that tie at the boundary are told apart exactly, by id.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratelens.llm.common import staged

SCALE, K, ONE_IN = 256, 5, 50
#: Rows of a block.
BLOCK = 4096
#: Components of the queries that are broadcast at once (8 bytes each); more queries take further passes.
ASKED = 4_000_000
#: Quantised components of this size and more would not fit a long when multiplied and summed.
LARGEST = 2**28


def quantised(rows: DataFrame) -> DataFrame:
    """(vec_id, q): the rows that take part, with floor(SCALE * x) of each component."""
    q = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    fine = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < LARGEST / SCALE, F.lit(False)))  # false for null, NaN, infinite
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"))


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors as rows; shorter ones are filled with 0."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def sliced(ids: np.ndarray, q: np.ndarray) -> tuple[bytes, list[int], list[int], bytes]:
    """(ids, smallest value and number of slices of each component, slices) of a block; rows in order of ids.

    Slices are bitmaps of whole 64-bit words: of the first component from its lowest bit on, of the second, ...
    """
    order = np.argsort(ids, kind="stable")
    ids, q = ids[order], q[order]
    least = q.min(0, initial=LARGEST) if len(q) else np.zeros(q.shape[1], np.int64)
    rest = np.zeros((-(-len(ids) // 64) * 64, q.shape[1]), np.int64)
    rest[: len(ids)] = q - least
    widths = [int(x).bit_length() for x in rest.max(0, initial=0)]
    slices = [np.packbits(rest[:, j] >> b & 1, bitorder="little") for j, w in enumerate(widths) for b in range(w)]
    return ids.tobytes(), least.tolist(), widths, b"".join(s.tobytes() for s in slices)


def index(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """(ids, least, widths, slices): the index, a row a block, written. ``vectors`` has vec_id, q."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                made = sliced(part.column("vec_id").to_numpy(), matrix(part.column("q")))
                yield pa.RecordBatch.from_pylist([dict(zip(("ids", "least", "widths", "slices"), made, strict=True))], SLICED)

    parts = max(1, math.ceil(vectors.count() / block))
    return staged(vectors.repartition(parts).mapInArrow(run, "ids binary, least array<long>, widths array<int>, slices binary"), "none")


SLICED = pa.schema([("ids", pa.binary()), ("least", pa.list_(pa.int64())), ("widths", pa.list_(pa.int32())), ("slices", pa.binary())])


class Block:
    """One block of the index and the arithmetic on its bitmaps."""

    def __init__(self, ids: bytes, least: list[int], widths: list[int], slices: bytes):
        self.ids, self.least = np.frombuffer(ids, np.int64), least
        words = -(-len(self.ids) // 64)
        self.slices = np.frombuffer(slices, np.uint64).reshape(-1, words)
        self.component = np.repeat(np.arange(len(widths)), widths)
        self.bit = np.concatenate([np.arange(w) for w in widths] or [np.empty(0, np.int64)]).astype(np.int64)
        self.widths = widths
        self.complements = ~self.slices
        self.all = np.packbits(np.arange(words * 64) < len(self.ids), bitorder="little").view(np.uint64)

    def summed(self, q: np.ndarray) -> tuple[list[np.ndarray], int]:
        """(slices of the sum of |q| times slices, what the scores are more than that sum)."""
        q = q[: len(self.least)]
        q = np.concatenate([q, np.zeros(len(self.least) - len(q), np.int64)])
        size, own = np.abs(q), q[self.component] < 0
        used = np.where(own[:, None], self.complements, self.slices)
        levels: list[list[np.ndarray]] = []
        for b in range(int(size.max(initial=0)).bit_length()):
            has = (size[self.component] >> b & 1).astype(bool)
            for c in range(max(self.widths, default=0)):
                some = used[has & (self.bit == c)]
                if len(some):
                    while len(levels) <= b + c:
                        levels.append([])
                    levels[b + c].append(some)
        shift = sum(int(x) * int(m) - (-int(x) * ((1 << w) - 1) if x < 0 else 0) for x, m, w in zip(q, self.least, self.widths, strict=True))
        return added(levels), shift

    def best(self, q: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k rows with the highest scores but those of id ``own``; ties to smaller ids."""
        total, shift = self.summed(q)
        able = self.all.copy()
        for row in range(*(np.searchsorted(self.ids, own, s) for s in ("left", "right"))):
            able[row // 64] &= ~np.uint64(1 << row % 64)
        sure, open_, n_sure = np.zeros_like(able), able, 0
        for slice_ in reversed(total):
            with_bit = open_ & slice_
            n = int(np.bitwise_count(with_bit).sum())
            if n_sure + n > k:
                open_ = with_bit
            else:
                sure, n_sure, open_ = sure | with_bit, n_sure + n, open_ & ~slice_
            if n_sure == k:
                break
        rows = [*places(sure), *places(open_)[: k - n_sure]]  # rows are in order of ids: the first of a tie stay
        found = [(shift + sum(int(s[r // 64] >> np.uint64(r % 64) & np.uint64(1)) << t for t, s in enumerate(total)), int(self.ids[r])) for r in rows]
        return sorted(found, key=lambda x: (-x[0], x[1]))


def places(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def added(levels: list[list[np.ndarray]]) -> list[np.ndarray]:
    """One slice a level, the sum of the bitmaps of all levels: three of one become one and one of the next."""
    out, t = [], 0
    while t < len(levels):
        stack = np.concatenate(levels[t]) if levels[t] else None
        while stack is not None and len(stack) > 1:
            if t + 1 == len(levels):
                levels.append([])
            third = len(stack) // 3
            if third:
                a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
                odd = a ^ b
                levels[t + 1].append(a & b | odd & c)
                stack = np.concatenate([odd ^ c, stack[3 * third :]])
            else:
                levels[t + 1].append(stack[:1] & stack[1:])
                stack = stack[:1] ^ stack[1:]
        out.append(stack[0] if stack is not None else None)
        t += 1
    empty = next((np.zeros_like(s) for s in out if s is not None), None)
    return [s if s is not None else empty for s in out]


def searched(rows: DataFrame, k: int = K, one_in: int = ONE_IN) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of each row whose id ``one_in`` divides.

    Rows with a null id, a null vector or a null or non-finite component take no part, nor do components
    of 2**20 and more in size, whose products may not fit a long. A shorter vector counts as filled with 0, an
    empty one has score 0 with all. A row with the query's id is never its result; a query row that is there
    twice is answered twice. An empty table gives no rows; other columns are not read.
    """
    spark = rows.sparkSession
    vectors = staged(quantised(rows))
    blocks = index(vectors)
    asked = staged(vectors.where(F.col("vec_id") % one_in == 0).withColumn("query", F.monotonically_increasing_id()))
    n, widest = asked.agg(F.count("*"), F.max(F.size("q"))).first()
    passes = max(1, math.ceil(n * max(widest or 1, 1) / ASKED))
    found = None
    for turn in range(passes):
        now = asked.where(F.pmod(F.xxhash64("query"), F.lit(passes)) == turn)
        shared = spark.sparkContext.broadcast([(r.query, r.vec_id, np.array(r.q, np.int64)) for r in now.toLocalIterator()])  # about ASKED components
        more = answered(blocks, shared, k)
        more = more if passes == 1 else staged(more)
        found = more if found is None else found.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def answered(blocks: DataFrame, shared, k: int) -> DataFrame:
    """(query, query_id, vec_id, score): the k best of each block for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(*(batch.column(c)[row].as_py() for c in SLICED.names))
                out = [(number, own, i, s) for number, own, q in shared.value for s, i in block.best(q, own, k)]
                columns = list(zip(*out, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query", "query_id", "vec_id", "score"])

    return blocks.mapInArrow(run, "query long, query_id long, vec_id long, score long")

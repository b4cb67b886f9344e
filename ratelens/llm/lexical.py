"""Ranked lexical search: term at a time, with a limit on accumulators.

An inverted index in blocks of documents holds, for every term that is asked for, the documents of the block and
how often they have it. A block answers an item by itself, its terms from the rarest on, whose weights are the
highest. A document gets an accumulator when a term finds it; once what the terms to come can add at most is less
than the k-th partial score, no document without an accumulator can come among the best, so no more are made, and
the rest of the lists only continues the accumulators there are, exactly. Every block hands on its k best.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratelens.llm.common import staged

K = 10
#: Documents of a block, and characters of text after which one is closed.
BLOCK, BLOCK_CHARS = 4096, 16_000_000
#: Terms of the items of one pass, which every task holds; more items take further passes. One item is never split.
ASKED = 1_000_000
# What parts terms, all of ASCII but letters and digits; A-Z become a-z.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
INDEX = "ids array<long>, sizes array<int>, terms array<int>, starts array<int>, docs array<int>, times array<int>, n_docs long, n_terms long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


def asked(items: DataFrame) -> DataFrame:
    """(item, item_id, terms): the items with a term, numbered, with their distinct terms in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(t.as_buffer().to_pybytes()))) if t.is_valid else [] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], names=["item", "item_id", "terms"])

    numbered = staged(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()))
    kind = numbered.schema["item_id"].dataType.simpleString()
    return staged(numbered.select("item", "item_id", "text").mapInArrow(run, f"item long, item_id {kind}, terms array<binary>").where("size(terms) > 0"))


def block_of(ids: list, sizes: list[int], found: list[tuple[np.ndarray, np.ndarray]]) -> dict:
    """A row of the index. ``found`` has the terms (sorted) of each document and how often it has them."""
    each = np.array([len(t) for t, _ in found], np.int64)
    terms = np.concatenate([t for t, _ in found] or [np.empty(0, np.int64)])
    times = np.concatenate([n for _, n in found] or [np.empty(0, np.int64)])
    order = np.argsort(terms, kind="stable")  # documents of a term stay in order
    kinds, starts = np.unique(terms[order], return_index=True)
    docs = np.repeat(np.arange(len(ids)), each)[order]
    return {
        "ids": ids, "sizes": sizes, "terms": kinds, "starts": np.append(starts, len(docs)), "docs": docs, "times": times[order],
        "n_docs": sum(s > 0 for s in sizes), "n_terms": sum(sizes),
    }


def index(docs: DataFrame, shared) -> DataFrame:
    """The inverted index of ``docs`` over the broadcast dictionary of terms, a row a block, written.

    ids and sizes (all terms, with repeats) of the documents; of each term by its number the documents, by their
    place in the block, and their counts, from starts on.
    """
    fields = [(c.split()[0], {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}[c.split()[1]]) for c in INDEX.split(", ")]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        ids, sizes, found, chars = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                terms = terms_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                if not terms:
                    continue  # found by no item, and counted nowhere
                known = np.array([number[t] for t in terms if t in number], np.int64)
                ids.append(doc_id.as_py())
                sizes.append(len(terms))
                found.append(np.unique(known, return_counts=True))
                chars += len(terms)
                if len(ids) >= BLOCK or chars >= BLOCK_CHARS:
                    yield pa.RecordBatch.from_pylist([block_of(ids, sizes, found)], schema)
                    ids, sizes, found, chars = [], [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([block_of(ids, sizes, found)], schema)

    return staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, INDEX), "zstd")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Block:
    """One block of the index, ready to answer items."""

    def __init__(self, row: dict, n_docs: int, n_terms: int, weights: dict[int, int]):
        self.ids = row["ids"]
        self.starts = np.array(row["starts"])
        self.docs, times = np.array(row["docs"], np.int64), np.array(row["times"], np.int64)
        # In Python's integers: the product need not fit a long.
        m = np.array([10 + 90 * int(n) * n_docs // n_terms for n in row["sizes"]], np.int64)
        self.place = {t: k for k, t in enumerate(row["terms"])}
        w = np.repeat([weights[t] for t in row["terms"]], np.diff(self.starts)).astype(np.int64)
        self.gains = w * (1_000_000_000 * times // (1000 * times + 8 * m[self.docs]))
        self.most = [int(self.gains[a:b].max(initial=0)) for a, b in zip(self.starts, self.starts[1:])]
        self.order = np.argsort(np.array([-(2**63) if i is None else i for i in self.ids], np.int64), kind="stable").argsort(kind="stable")

    def best(self, terms: list[int], k: int) -> list[tuple[int, int | None]]:
        """(score, doc_id) of the k best documents; ``terms`` from the rarest on. Ties go to the smaller id, null first."""
        lists = [self.place[t] for t in terms if t in self.place]
        to_come = np.cumsum([self.most[p] for p in reversed(lists)])[::-1].tolist() + [0]
        score = np.zeros(len(self.ids), np.int64)
        live = np.zeros(len(self.ids), bool)
        creating = True
        for turn, p in enumerate(lists):
            some = slice(self.starts[p], self.starts[p + 1])
            docs, gains = self.docs[some], self.gains[some]
            if creating and live.sum() >= k:
                partial = score[live]
                creating = to_come[turn] >= np.partition(partial, len(partial) - k)[len(partial) - k]
            if creating:
                live[docs] = True
            else:
                there = live[docs]
                docs, gains = docs[there], gains[there]
            score[docs] += gains  # a list has a document once
        at = np.flatnonzero(score > 0)
        at = at[np.lexsort((self.order[at], -score[at]))[:k]]
        return [(int(score[a]), self.ids[a]) for a in at]


def ranked(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of ``docs`` (doc_id, text) for each of ``items`` (item_id, text).

    A null text has no terms: an item without terms has no rows, a document without terms is found by none. Scores
    of 0 are no results. Items are told apart by a number, so repeated ids or rows are answered one by one;
    repeated documents are results of their own. Equal scores go by doc_id, null first. Empty tables give no
    rows. Other columns are not read.
    """
    every = asked(items)
    passes = max(1, math.ceil((every.agg(F.sum(F.size("terms"))).first()[0] or 0) / ASKED))
    found = None
    for turn in range(passes):
        now = every.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == turn)
        more = one_pass(docs, now, k)
        more = more if passes == 1 else staged(more)
        found = more if found is None else found.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(every.select("item", "item_id"), "item").select("item_id", "rank", F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "score")


def one_pass(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(item, doc_id, score): the k best of every block. The terms of ``items`` are about ASKED at most."""
    spark = docs.sparkSession
    wanted = [(r["item"], [bytes(t) for t in r["terms"]]) for r in items.select("item", "terms").toLocalIterator()]
    number = {t: i for i, t in enumerate(sorted({t for _, terms in wanted for t in terms}))}
    blocks = index(docs, spark.sparkContext.broadcast(number))
    n_docs, n_terms = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    # One row a block and term: the length of its list there.
    lengths = F.expr("transform(terms, (t, i) -> struct(t, starts[i + 1] - starts[i] as n))")
    df = blocks.select(F.explode(lengths).alias("x")).groupBy("x.t").agg(F.sum("x.n").alias("df"))
    weights = {r.t: (weight(n_docs, r.df), r.df) for r in df.toLocalIterator()}  # a row a term asked for
    rarest = [(item, sorted((number[t] for t in terms if number[t] in weights), key=lambda t: (weights[t][1], t))) for item, terms in wanted]
    shared = spark.sparkContext.broadcast((n_docs, n_terms, {t: w for t, (w, _) in weights.items()}, rarest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs, n_terms, weights, rarest = shared.value
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block(batch.slice(at, 1).to_pylist()[0], n_docs, n_terms, weights)
                out = [(item, i, s) for item, terms in rarest for s, i in block.best(terms, k)]
                columns = list(zip(*out, strict=True)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    return blocks.mapInArrow(run, "item long, doc_id long, score long")

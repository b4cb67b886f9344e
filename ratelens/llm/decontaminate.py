"""Benchmark decontamination with a distributed positional inverted index.

The index holds, for the rarest terms of every test window, the positions at which training documents
have them. Lists are shifted by the term's offset in the window and intersected: where all of a window's
rare terms agree on a start, the window's words are compared with the document's. Starts that agree only
within a slop are proximity matches. Everything is DataFrame code.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratelens.llm.common import BROADCAST_ROWS, ascii_lower, small, staged, text_of

#: What parts words: all of ASCII but letters and digits.
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WINDOW, TERMS, SLOP = 13, 3, 3
#: A document is contaminated if it has hit words and they are at least one in so many.
ONE_IN = 20


def terms_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), BREAKS), "")


def windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """(wid, terms, items): every distinct window once with the items that have it.

    An item of fewer than ``width`` words is one window; one without words has none. An item without an
    id hits words but is not listed.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), terms_of(text_of()).alias("all")).where("size(`all`) > 0")
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("all") - width + 1, F.lit(1)))).alias("s")
    each = items.select("item", "all", starts).select("item", F.slice("all", F.col("s"), F.lit(width)).alias("terms"))
    return each.groupBy("terms").agg(F.sort_array(F.collect_set("item")).alias("items")).withColumn("wid", F.xxhash64("terms"))


def anchors(docs: DataFrame, wins: DataFrame, terms: int = TERMS) -> DataFrame:
    """(term, wid, shift, mask, full): for each window its ``terms`` places whose terms are rarest in training."""
    places = wins.select("wid", F.posexplode("terms").alias("shift", "term"))
    vocabulary = staged(places.select("term").distinct())
    counts = (
        docs.select(F.explode(terms_of(text_of())).alias("term"))
        .join(small(vocabulary), "term")
        .groupBy("term")
        .agg(F.count("*").alias("n"))
    )
    rank = F.row_number().over(Window.partitionBy("wid").orderBy("n", "term", "shift"))  # at most WINDOW rows
    ranked = places.join(staged(counts), "term", "left").fillna(0, ["n"]).withColumn("rank", rank).where(F.col("rank") <= terms)
    full = F.sum(F.expr("shiftleft(1, rank - 1)")).over(Window.partitionBy("wid"))
    return ranked.select("term", "wid", "shift", F.expr("shiftleft(1, rank - 1)").alias("mask"), full.cast("int").alias("full"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, doc, pos): the positional index of ``terms`` (unique) over all documents, written out."""
    where = docs.select("doc", F.posexplode(terms_of(text_of())).alias("pos", "term"))
    return staged(where.join(small(staged(terms)), "term"))


def matches(index: DataFrame, places: DataFrame, slop: int = SLOP) -> DataFrame:
    """(doc, wid, start, exact): starts on which a window's rare terms agree, exactly or within ``slop``."""
    shifted = (
        index.join(small(places), "term")
        .select("doc", "wid", (F.col("pos") - F.col("shift")).alias("start"), "mask", "full")
        .groupBy("doc", "wid", "start", "full")
        .agg(F.bit_or("mask").alias("mask"))
    )
    near = F.bit_or("mask").over(Window.partitionBy("doc", "wid").orderBy("start").rangeBetween(-slop, slop))
    found = shifted.withColumn("near", near).where("near = full")
    return found.select("doc", "wid", "start", (F.col("mask") == F.col("full")).alias("exact"))


def with_found(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` left-joined with ``found`` (unique on doc). As a rule few documents have matches: only those are shuffled."""
    marks = found.select("doc")
    if marks.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return docs.join(found, "doc", "left")
    marks = F.broadcast(marks)
    clean = docs.join(marks, "doc", "left_anti").withColumn("found", F.lit(None).cast(found.schema["found"].dataType))
    return docs.join(marks, "doc", "left_semi").join(found, "doc").unionByName(clean)


def scanned(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, terms: int = TERMS, slop: int = SLOP) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, n_near, items_sha256, contaminated.

    A word is hit if it lies in an occurrence of any window. A null or empty text has no words and is
    clean. Rows with equal doc_id and text are one document to the index and all get its result. n_near
    counts windows whose rare terms stand close together without the whole phrase. An empty benchmark
    leaves every document clean. A column of ``docs`` with the name of a result is replaced.
    """
    results = ["n_words", "n_hit", "n_items", "n_near", "items_sha256", "contaminated"]
    docs = docs.drop(*[c for c in docs.columns if c in [*results, "doc", "found", "terms"]])
    docs = docs.withColumn("doc", F.xxhash64("doc_id", "text"))
    wins = staged(windows(benchmark, width))
    places = staged(anchors(docs.select("text"), wins, terms))
    index = postings(docs.select("doc", "text"), places.select("term").distinct())
    found = matches(index, places, slop).join(small(wins), "wid")
    cell = F.struct("start", "terms", "items", "exact", "wid")
    found = staged(found.groupBy("doc").agg(F.collect_list(cell).alias("found")))  # bounded by the document's length
    joined = with_found(docs, found).withColumn("terms", terms_of(text_of()))
    occurs = (
        "get(transform(array(terms), t -> filter(coalesce(found, array()), f -> f.exact and f.start >= 0"
        " and slice(t, greatest(f.start, 0) + 1, size(f.terms)) = f.terms)), 0)"
    )
    spans = "array_sort(transform(hits, f -> struct(f.start as s, f.start + size(f.terms) as e)))"
    covered = (
        f"aggregate({spans}, struct(0 as done, 0 as n), (a, f) ->"
        " struct(greatest(a.done, f.e) as done, a.n + greatest(f.e - greatest(f.s, a.done), 0) as n)).n"
    )
    return (
        joined.withColumn("hits", F.expr(occurs))
        .withColumn("items", F.expr("array_sort(array_distinct(flatten(transform(hits, f -> f.items))))"))
        .withColumn("n_words", F.size("terms").cast("long"))
        .withColumn("n_hit", F.expr(covered).cast("long"))
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn(
            "n_near",
            F.expr(
                "cast(size(array_except(array_distinct(transform(coalesce(found, array()), f -> f.wid)),"
                " transform(hits, f -> f.wid))) as long)"
            ),
        )
        .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words")))
        .drop("doc", "found", "terms", "hits", "items")
    )

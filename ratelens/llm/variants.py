"""Spelling variants of words, grouped by one-edit neighbourhoods over a reduced alphabet.

Every letter is hashed to one of a few symbols, so a word becomes a short string over these symbols. Words
that are one edit apart have reduced words that are at most one edit apart: the full one-edit neighbourhood
(and the reduced word itself) of every word is generated and joined to the reduced vocabulary, and what joins
is verified on the original strings. One edit leaves the front or the back half of the longer or equal word
untouched, and the place of an edit tells which: that half stands in the key, so a common reduced word is no
hot list. Of a pair that both halves could find, only the front half's find counts, so no pair is found twice.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import staged

#: UTF-8 of letters that are in no run: all of two bytes and more but U+00C0 to U+00FF.
OTHER = re.compile(rb"(?:[\xC2\xC4-\xFF][\x80-\xBF]*)+")
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
#: Of the symbols that letters are hashed to.
SYMBOLS = "0123"
LEAST_LENGTH, LEAST_N, RATIO = 6, 5, 5
#: One run in so many (by crc32 with its document) loses a letter.
ONE_IN = 199
#: Distinct words a task counts before it hands its counts on.
HELD = 300_000


def runs_of(text: bytes) -> list[bytes]:
    """Runs of letters of a UTF-8 text that have enough bytes; A-Z lowered. Letters past ASCII begin with byte C3."""
    return [w for w in OTHER.sub(b" ", text).translate(PLAIN).split() if len(w) >= LEAST_LENGTH]


def counted(docs: DataFrame) -> DataFrame:
    """(word, n) of every task: runs of letters, A-Z lowered, with the letter deletions of the contract."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def told() -> pa.RecordBatch:
            words = [(word, n) for raw, n in total.items() if n and len(word := raw.decode()) >= LEAST_LENGTH]
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in words], pa.string()), pa.array([n for _, n in words], pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                if not text.is_valid:
                    continue
                runs = runs_of(text.as_buffer().to_pybytes())
                total.update(runs)
                prefix = zlib.crc32(f"{doc_id.as_py() or ''}:".encode())
                for raw in [w for w in set(runs) if not zlib.crc32(w, prefix) % ONE_IN]:
                    word, n = raw.decode(), runs.count(raw)
                    at = zlib.crc32(raw, prefix) % len(word)
                    total[raw] -= n
                    total[(word[:at] + word[at + 1 :]).encode()] += n
                if len(total) >= HELD:
                    yield told()
        yield told()

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(run, "word string, n long")


def vocabulary(docs: DataFrame, least: int = LEAST_N) -> DataFrame:
    """(word, n): the words with at least ``least`` occurrences in all documents."""
    return counted(docs).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def reduced(word: Column) -> Column:
    """The word over the few symbols: each letter's symbol is a hash of its code point."""
    symbols = "".join(SYMBOLS[((ord(c) * 2654435761) >> 7) % len(SYMBOLS)] for c in LETTERS)
    return F.translate(word, LETTERS, symbols)


def neighbourhood() -> Column:
    """Distinct keys of the word ``w`` with reduced word ``r`` of length ``l``: every reduced word within one edit.

    A key is a hash of the reduced word, of the side of the half and of the half of the original word that the
    edit leaves alone. The half is that of the word looked for, whose length the edit tells.
    """
    symbols = ", ".join(f"'{s}'" for s in SYMBOLS)

    def keys(places: str, target: str, made: str) -> str:
        # e: place of the edit from 0; a half of length h in front of it is untouched, else the one behind it.
        half = f"({target}) div 2"
        return (
            f"flatten(transform({places}, e -> transform({made}, x -> if(e >= {half}, xxhash64(x, 0, left(w, {half})), xxhash64(x, 1, right(w, {half}))))))"
        )

    deleted = keys("sequence(0, l - 1)", "l - 1", "array(concat(left(r, e), substr(r, e + 2)))")
    replaced = keys(
        "sequence(0, l - 1)", "l", f"transform(filter(array({symbols}), s -> s <> substr(r, e + 1, 1)), s -> concat(left(r, e), s, substr(r, e + 2)))"
    )
    inserted = keys("sequence(0, l)", "l + 1", f"transform(array({symbols}), s -> concat(left(r, e), s, substr(r, e + 1)))")
    same = "array(xxhash64(r, 0, left(w, l div 2)), xxhash64(r, 1, right(w, l div 2)))"
    return F.expr(f"array_distinct(concat({same}, {deleted}, {replaced}, {inserted}))")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every ordered pair of ``words`` (word, n) at exactly one edit, once."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = words.repartition(parts)  # few bytes of words become many keys: not by the size of what is read
    own = spread.select(F.col("word").alias("w"), "n", reduced(F.col("word")).alias("r"), F.length("word").alias("l"))
    asked = own.select("w", F.explode(neighbourhood()).alias("key"))
    sides = F.expr("array(struct(0 as side, xxhash64(r, 0, left(w, l div 2)) as key), struct(1 as side, xxhash64(r, 1, right(w, l div 2)) as key))")
    entries = own.select(F.col("w").alias("v"), "n", "l", F.explode(sides).alias("s")).select("s.key", "s.side", "v", "n", "l")
    # The vocabulary is the small side of every partition: two entries a word against its whole neighbourhood.
    found = asked.join(
        entries.hint("shuffle_hash"),
        (asked.key == entries.key) & F.expr("(side = 0 or left(w, l div 2) <> left(v, l div 2)) and levenshtein(w, v, 1) = 1"),
    )
    return found.select(F.col("w").alias("word"), F.col("v").alias("near"), F.col("n").alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the last word that forms lead to. Words double their steps each round.

    A form occurs ``RATIO`` times as often as its word, so chains end and are short: their length is at most the
    logarithm of the most frequent word's count.
    """
    steps = staged(forms.select("word", F.col("form").alias("root")))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps_ = staged(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if steps_.where("moved").isEmpty():
            return steps_.select("word", "root")
        steps = steps_.select("word", "root")


def grouped(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs`` (doc_id, text).

    A null text has no words; a null doc_id counts as an empty one. Repeated rows count each time. Ties for a
    form go to the smallest word in code-point order, which is Spark's order of strings. An empty table, or one
    without a word frequent enough, gives no rows. Other columns are not read.
    """
    words = staged(vocabulary(docs))
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form"))).alias("best")
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    known = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best.form", (-F.col("best.minus")).alias("form_n"))
    fits = F.col("form_n") >= RATIO * F.col("n")
    known = staged(known.withColumns({"form": F.when(fits, F.col("form")), "form_n": F.when(fits, F.col("form_n"))}))
    out = known.join(roots(known.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.col("n_near").cast("long").alias("n_near"), "form_n")

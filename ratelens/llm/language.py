"""Language identification, words first.

A known word scores by its log frequency in each language. An unseen word falls back to its character
n-grams, the longest first, and to shorter ones only while none of a length is known.
"""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratelens.llm.common import staged, with_ids_as_text

LETTERS = re.compile(r"[^\W\d_]+")
LONGEST = 5
#: Labelled documents the model learns from at most (the smallest hashes of doc_id), and the words and,
#: for each length, n-grams it keeps, shared evenly among the languages. They bound what is broadcast.
SAMPLE_ROWS, KEPT_WORDS, KEPT_GRAMS = 20_000, 100_000, 40_000


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def pieces(word: str, length: int) -> list[str]:
    padded = f"<{word}>"
    return [padded[i : i + length] for i in range(len(padded) - length + 1)]


def counts(sample: DataFrame) -> DataFrame:
    """(lang, length, piece, n): words (length 0) and n-grams of the sample.

    Words are counted first; n-grams are cut from distinct words and count as often as their word.
    """

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total: Counter = Counter()
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                for word, n in Counter(LETTERS.findall(text.lower())).items():
                    total[lang, word] += n
            keys = list(total)
            yield pd.DataFrame({"lang": [k[0] for k in keys], "piece": [k[1] for k in keys], "n": list(total.values())})

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total: Counter = Counter()
            for lang, word, n in zip(batch["lang"], batch["piece"], batch["n"], strict=True):
                for length in range(1, LONGEST + 1):
                    for piece in pieces(word, length):
                        total[lang, length, piece] += n
            keys = list(total)
            yield pd.DataFrame({"lang": [k[0] for k in keys], "length": [k[1] for k in keys], "piece": [k[2] for k in keys], "n": list(total.values())})

    parts = int(sample.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = sample.select("lang", "text").mapInPandas(words, "lang string, piece string, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    known = staged(known)
    cut = known.repartition(parts).mapInPandas(grams, "lang string, length int, piece string, n long")
    return known.select("lang", F.lit(0).alias("length"), "piece", "n").unionByName(cut.groupBy("lang", "length", "piece").agg(F.sum("n").alias("n")))


# Words whose frequencies a task keeps at hand; a text with more of them is counted in parts.
CACHED_WORDS = 200_000


class Model:
    """Log frequencies by language of words and n-grams."""

    def __init__(self, langs: list[str], tables: dict[int, dict[str, np.ndarray]]):
        self.langs, self.tables = langs, tables

    def rows(self) -> dict[int, tuple[dict[str, int], np.ndarray]]:
        """Per length the place of each piece and the matrix of its frequencies."""
        return {k: ({p: i for i, p in enumerate(t)}, np.stack(list(t.values()))) for k, t in self.tables.items() if t}

    def vector(self, word: str) -> np.ndarray:
        return vectors(self.rows(), [word], len(self.langs))[0]


def vectors(rows: dict, words: list[str], langs: int) -> np.ndarray:
    """A row per word: its own frequencies, else the mean of its longest known n-grams, else zeros."""
    out = np.zeros((len(words), langs), np.float32)
    own, found = rows.get(0, ({}, out))
    lengths = [(k, rows[k][0]) for k in range(LONGEST, 0, -1) if k in rows]
    at, places, by_length = [], [], {k: ([], [], []) for k, _ in lengths}
    for i, word in enumerate(words):
        place = own.get(word)
        if place is not None:
            at.append(i)
            places.append(place)
            continue
        for k, index in lengths:
            known = [index[p] for p in pieces(word, k) if p in index]
            if known:
                which, starts, flat = by_length[k]
                which.append(i)
                starts.append(len(flat))
                flat += known
                break
    if at:
        out[at] = found[places]
    for k, (which, starts, flat) in by_length.items():
        if which:
            n = np.diff(np.array([*starts, len(flat)]))
            out[which] = np.add.reduceat(rows[k][1][flat], starts, axis=0) / n[:, None].astype(np.float32)
    return out


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, words: int = KEPT_WORDS, grams: int = KEPT_GRAMS) -> Model:
    """The model of at most ``rows`` documents with lang and text that are not held out."""
    able = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    chosen = staged(able.select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(rows))
    last = chosen.agg(F.max("h")).first()[0]
    if last is None:
        return Model([], {})
    sample = able.where(F.xxhash64("doc_id") <= F.lit(last))
    found = staged(counts(sample))
    totals: dict = {}
    langs = sorted({r[0] for r in found.select("lang").distinct().collect()})
    for lang, length, n, kinds in found.groupBy("lang", "length").agg(F.sum("n"), F.count("*")).collect():
        totals[lang, length] = (n, kinds)
    rank = F.row_number().over(Window.partitionBy("lang", "length").orderBy(F.desc("n"), "piece"))
    share = F.when(F.col("length") == 0, words // len(langs)).otherwise(grams // len(langs))
    kept = found.withColumn("rank", rank).where(F.col("rank") <= share).select("length", "piece").distinct()
    by_lang: dict = {}
    for lang, length, piece, n in found.join(kept, ["length", "piece"]).select("lang", "length", "piece", "n").collect():
        by_lang.setdefault(length, {}).setdefault(piece, {})[lang] = n
    tables: dict = {}
    for length, pieces_ in by_lang.items():
        n, kinds = (np.array([totals.get((g, length), (0, 0))[k] for g in langs], float) for k in (0, 1))
        base = np.log(n + 0.5 * kinds.max() + 1)
        tables[length] = {p: (np.log(np.array([c.get(g, 0) + 0.5 for g in langs])) - base).astype(np.float32) for p, c in pieces_.items()}
    return Model(langs, tables)


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; only the text decides.

    A text that is null or has no letter is ``und`` with score 0, as is any text if nothing was learned.
    Ties go to the first language by name. Equal texts get equal results; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.tables))  # bounded by KEPT_*

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(*shared.value)
        known, place = own.rows(), {}
        cache = np.zeros((CACHED_WORDS, max(1, len(own.langs))), np.float32)
        for batch in batches:
            langs, scores = [], []
            for text in batch["text"]:
                seen = Counter(LETTERS.findall(text.lower())) if text else {}
                if not seen or not own.langs:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                total = np.zeros(len(own.langs))
                counted = list(seen.items())
                for start in range(0, len(counted), CACHED_WORDS):
                    part = counted[start : start + CACHED_WORDS]
                    new = [w for w, _ in part if w not in place]
                    if len(place) + len(new) > CACHED_WORDS:
                        place.clear()
                        new = [w for w, _ in part]
                    first = len(place)
                    if new:
                        cache[first : first + len(new)] = vectors(known, new, len(own.langs))
                        place.update(zip(new, range(first, first + len(new))))
                    total += np.array([n for _, n in part], float) @ cache[[place[w] for w, _ in part]]
                p = np.exp(total - total.max())
                best = int(np.argmax(total))
                langs.append(own.langs[best])
                scores.append(float(p[best] / p.sum()))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": langs, "score": scores})

    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    schema = "doc_id string, held_out boolean, lang_pred string, score double"
    return with_ids_as_text(rows, run, schema, "doc_id")


def identified(docs: DataFrame) -> DataFrame:
    return predicted(docs, train(docs))

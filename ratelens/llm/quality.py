"""Quality rules: counts of a text's shape, and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed words and word pairs are counted: one over trusted documents, one over the
whole raw corpus. A document's score is the mean log ratio of its n-grams. Everything is DataFrame code.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import bound, small, staged, text_of, words_of

BUCKETS = 16_384
MIN_WORDS, MOST_REPEATED = 50, 50
#: The share of the trusted documents that pass the rules above and may still be rejected.
TRUSTED_LOSS = 0.002
#: One of so many trusted documents is not counted: the limit is taken on those.
FOLDS = 5


def repeated(words: str) -> Column:
    """Words in 3-word windows found twice or more.

    A window is one long: a hash above, its position below. Sorted, equal windows stand side by side.
    """
    found = """
        get(transform(array({w}), w -> get(transform(array(cast(greatest(ceil(log2(size(w) + 1.0)), 1) as int)), b ->
        get(transform(array(sort_array(transform(slice(w, 1, greatest(size(w) - 2, 0)), (x, i) ->
            shiftleft(xxhash64(x, get(w, i + 1), get(w, i + 2)), b) | cast(i as bigint)))), c ->
        get(transform(array(sort_array(transform(filter(c, (x, i) ->
            shiftright(x, b) <=> shiftright(get(c, i + 1), b)
            or (i > 0 and shiftright(x, b) <=> shiftright(get(c, i - 1), b))), x -> x & (shiftleft(1L, b) - 1)))), r ->
        aggregate(transform(r, (p, i) -> least(3L, coalesce(get(r, i + 1) - p, 3L))), 0L, (n, x) -> n + x)
        ), 0)), 0)), 0)), 0)"""
    return F.expr(found.format(w=words))


def shape(docs: DataFrame) -> DataFrame:
    """``docs`` with words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text_of()
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^ \\x09-\\x0D]"))
    return (
        docs.withColumn("words", words_of(text))
        .withColumn("n_words", F.size("words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
        .withColumn("n_symbols", (F.size(F.split(text, "[#*$%&|<>]")) - 1).cast("long"))
        .withColumn("n_dup_lines", bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"))
        .withColumn("n_repeat_words", repeated("words"))
    )


def grams(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row a word of ``docs`` (words and more): the buckets of the word and of it with the next, or null."""
    after = docs.withColumn("after", F.slice("words", F.lit(2), F.size("words")))
    each = after.withColumn("pair", F.explode(F.arrays_zip("words", "after"))).drop("words", "after")
    one, two = F.xxhash64("pair.words"), F.xxhash64("pair.words", "pair.after")
    return each.select(
        *[c for c in docs.columns if c != "words"],
        F.pmod(one, F.lit(buckets)).cast("int").alias("one"),
        F.when(F.col("pair.after").isNotNull(), F.pmod(two, F.lit(buckets)).cast("int")).alias("two"),
    )


def failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, good) of every labelled document.

    A document with several labels is good only if all say so; null ids and null labels are left out.
    """
    known = labels.where("doc_id is not null and quality is not null")
    return known.groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))


def weights(docs: DataFrame, sample: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """log(P(bucket | trusted) / P(bucket | raw)), add-one smoothed; one number a bucket."""
    words = docs.join(small(sample.where("good")), "doc_id", "left").select(
        F.coalesce("good", F.lit(False)).alias("good"), words_of(text_of()).alias("words")
    )
    counts = (
        grams(words, buckets)
        .select("good", F.explode(F.array("one", "two")).alias("bucket"))
        .where("bucket is not null")
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.sum(F.col("good").cast("long")).alias("trusted"))
    )
    raw, trusted = [0] * buckets, [0] * buckets
    for bucket, r, t in counts.collect():  # at most one row a bucket
        raw[bucket], trusted[bucket] = r, t
    all_raw, all_trusted = sum(raw) + buckets, sum(trusted) + buckets
    return [math.log((t + 1) / all_trusted) - math.log((r + 1) / all_raw) for r, t in zip(raw, trusted, strict=True)]


def key_of(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(text, F.lit(1)).alias("k2")]


def mean_ratios(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """(k1, k2, ratio): the mean log ratio of the n-grams of every text that has words.

    Texts are told apart by 128 bits of hash. Copies add to sum and count alike, so the mean is that of one.
    """
    table = F.split(F.lit(",".join(f"{x:.12g}" for x in ratios)), ",").cast("array<double>")
    each = grams(docs.select(*key_of(text_of()), words_of(text_of()).alias("words")), len(ratios))
    value = F.get(table, F.col("one")) + F.coalesce(F.get(table, F.col("two")), F.lit(0.0))
    n = F.lit(1) + F.col("two").isNotNull().cast("int")
    return each.groupBy("k1", "k2").agg(F.round(F.sum(value) / F.sum(n), 9).alias("ratio"))


def kept_back() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("limit")), F.lit(FOLDS)) == 0


def threshold(docs: DataFrame, sample: DataFrame, scored: DataFrame, loss: float = TRUSTED_LOSS) -> float | None:
    """The score that the share ``loss`` of the trusted documents stays below; None without any.

    Of the trusted documents, those count that pass the base rules and were kept back, but for copies of one that was not.
    """
    good = docs.select("doc_id", "text").join(small(sample.where("good").select("doc_id")), "doc_id")
    trusted = shape(good.where(kept_back())).where(~failed()).select(*key_of(text_of()))
    fresh = trusted.join(good.where(~kept_back()).select(*key_of(text_of())), ["k1", "k2"], "left_anti")
    ratios = staged(fresh.join(scored, ["k1", "k2"]).select("ratio").where("ratio is not null"))
    place = (ratios.count() - 1) * loss
    if place < 0:
        return None
    # The two scores around the place, among as many of the lowest; no task holds all of them.
    low, *high = [r.ratio for r in ratios.orderBy("ratio").offset(math.floor(place)).limit(2).collect()]
    part = place - math.floor(place)
    return low if not part or high[0] == low else (1 - part) * low + part * high[0]


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio, kept.

    A null or empty text has no words and fails the base rules. Equal rows get equal verdicts. Without
    trusted documents that were kept back there is no limit to go by, and the base rules decide alone. Only doc_id and text
    are read; a column of ``docs`` with the name of a result is replaced.
    """
    sample = staged(labelled(labels))
    plain = docs.select("doc_id", "text")
    scored = staged(mean_ratios(plain, weights(plain, sample.where(~kept_back()))))
    limit = threshold(plain, sample, scored)
    verdict = ~F.col("base_failed") & (F.lit(True) if limit is None else F.col("ratio") >= F.lit(limit))
    return (
        shape(docs.drop("k1", "k2", "ratio"))
        .drop("words")
        .withColumns({c: k for c, k in zip(("k1", "k2"), key_of(text_of()), strict=True)})
        .join(scored, ["k1", "k2"], "left")
        .withColumn("base_failed", failed())
        .withColumn("kept", F.coalesce(verdict, F.lit(False)))
        .drop("k1", "k2")
    )

"""Mixing sources to target weights by weighted fair queueing.

A source's documents stand in a shuffled order. A document's virtual finish time is the source's
words up to and with it, divided by the source's target. All documents, and their second copies where
a source is taken twice, are sorted by finish time over the whole corpus; the mix is the sorted list up
to the total budget. Every source then has given its share of the budget but for one document.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import SPACES, running_total, small, staged, text_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words
MOST = 2  # times a source's own words


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target): ``weights`` repeat over the sources by code point, null last.

    The budget is ``share`` of all words. A source stops at ``most`` times its words; the excess goes to
    the others by weight until none is above: with sources ordered by ``most * size / weight``, those up
    to some point stop and the rest get ``level * weight``, which one running total finds.
    """
    ranked = running_total(sizes.withColumns({"last": F.col("source").isNull(), "one": F.lit(1)}), ["last", "source"], "one")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("seq") % len(weights) + 1).cast("int"))
    rows = staged(
        ranked.select("source", "source_size", weight.cast("long").alias("weight"))
        .withColumn("stop", F.col("source_size") * most)
        .withColumn("ratio", F.col("stop") / F.col("weight"))
    )
    total = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, all_weight = (total[0] or 0) * share, total[1] or 0
    order = ["ratio", "source"]
    stops = running_total(rows, order, "stop").withColumnRenamed("upto", "stopped").drop("seq")
    both = running_total(stops, order, "weight").withColumnRenamed("upto", "weighed").drop("seq")
    # The level if all before this source stop; the first source that does not stop then shows it.
    before_stop, before_weight = F.col("stopped") - F.col("stop"), F.col("weighed") - F.col("weight")
    level = (F.lit(budget) - before_stop) / (F.lit(float(all_weight)) - before_weight)
    found = both.select("ratio", level.alias("level")).where("level <= ratio").agg(F.min_by("level", "ratio")).first()[0]
    target = F.col("stop").cast("double") if found is None else F.least(F.col("stop").cast("double"), F.col("weight") * F.lit(float(found)))
    return rows.select("source", "source_size", target.alias("target"))


def n_words(text: Column) -> Column:
    """Words of ``text`` without building them: the pieces between spaces, less empty ones at the ends."""
    ends = F.when(text.rlike("^" + SPACES), 1).otherwise(0) + F.when(text.rlike(SPACES + "$"), 1).otherwise(0)
    return F.when(text.rlike("[^ \\x09-\\x0D]"), F.size(F.split(text, SPACES)) - ends).otherwise(0).cast("long")


def queue(docs: DataFrame, keep: str = "doc_id", seed: int = 17, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST):
    """(rows, cut): ``keep`` of every row with size, source_size, target, seq and upto; the last place taken.

    A source may hold any share of the rows: its order is part of one range sort over (source, hash), so
    a large source spans many ranges.
    """
    text = text_of()
    rows = staged(docs.select(keep, "source", n_words(text).alias("size"), F.xxhash64("doc_id", text, F.lit(seed)).alias("draw")))
    aims = staged(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most))
    shuffled = running_total(rows, ["source", "draw", keep, "size"], "size")
    starts = shuffled.groupBy("source").agg(F.min(F.col("upto") - F.col("size")).alias("start"))
    aims = aims.alias("t").join(starts.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source"))).select("t.*", "s.start")
    rows = staged(
        shuffled.alias("r")
        .join(small(aims).alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
        .select(f"r.{keep}", "r.size", "r.seq", "t.source_size", "t.target", (F.col("upto") - F.col("start")).alias("upto"))
    )
    each = (
        rows.where("target > 0")
        .select("*", F.explode(F.array(*[F.lit(t).cast("long") for t in range(most)])).alias("turn"))
        .withColumn("finish", finish(F.col("turn")))
        .where(F.col("finish") - F.col("size") / F.col("target") < 1)  # by a start of 1 all targets are met
    )
    budget = rows.agg(F.sum("size")).first()[0] or 0
    ordered = running_total(each.select("finish", "turn", F.col("seq").alias("place"), "size"), ["finish", "turn", "place"], "size")
    cut = ordered.where(F.col("upto") <= F.lit(budget * share)).agg(F.max(F.struct("finish", "turn", "place"))).first()[0]
    return rows, cut


def finish(turn: Column) -> Column:
    """Virtual finish time of the copy numbered ``turn``."""
    return (F.col("upto") + turn * F.col("source_size")) / F.col("target")


def with_copies(rows: DataFrame, cut, most: int = MOST) -> DataFrame:
    """``rows`` with ``copies``, how often the mix takes the row."""
    if cut is None:
        return rows.withColumn("copies", F.lit(0))
    last = F.struct(F.lit(cut[0]).alias("finish"), F.lit(cut[1]).cast("long").alias("turn"), F.lit(cut[2]).cast("long").alias("place"))
    copies = F.lit(0)
    for turn in range(most):
        at = F.lit(turn).cast("long")
        place = F.struct(F.when(F.col("target") > 0, finish(at)).alias("finish"), at.alias("turn"), F.col("seq").alias("place"))
        copies = copies + F.when((F.col("target") > 0) & (place <= last), 1).otherwise(0)
    return rows.withColumn("copies", copies)


def mix(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row.

    A null or blank text has size 0 and is taken for no words; a source without words has target 0. Equal
    rows stand side by side in the queue and are told apart by their place in it. Other columns are not
    read. An empty table gives an empty result.
    """
    rows, cut = queue(docs, **how)
    out = with_copies(rows, cut, how.get("most", MOST))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix with the columns of ``docs``; one that is taken twice stands there twice.

    Rows are numbered in a written copy, so equal rows keep places of their own.
    """
    marked = staged(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("number")))
    rows, cut = queue(marked.select("row.doc_id", "row.text", "row.source", "number"), keep="number", **how)
    chosen = with_copies(rows, cut, how.get("most", MOST)).where("copies > 0").select("number", "copies")
    again = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    return marked.join(chosen, "number").select("row", again).select("row.*")

"""Elements of the array in a JSON document of any size, without the document in one task.

Spark splits a document at closing braces. A chunk tells how many quotes it holds and by how much it changes the
depth of brackets, for a begin outside and inside of a string. A prefix scan over a file's few blocks, and one within
each block, give the state and the depth every chunk begins with; an element ends where the depth is back at its
array's. Only the chunks of one element meet in one row.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelens.sources.files import decoded, encodings, scan, with_line_numbers
from ratelens.sources.tables import broadcast_if_small, written

SEPARATOR = "}"
SCALAR = r'(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|[-+.0-9eE]++|true|false|null)'


def chunks(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """Texts between closing braces (source_path, block, position, bytes, file_size_bytes); large files split."""
    return scan(spark, folder, pattern, SEPARATOR)


def _count(text: Column, marks: str) -> Column:
    return F.length(text) - F.length(F.translate(text, marks, ""))


def _unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\.", "")


def _net(text: Column, inside) -> Column:
    """By how much ``text`` changes the depth, begun inside of a string or not; strings count for nothing."""
    whole = F.when(inside, F.concat(F.lit('"'), _unescaped(text))).otherwise(_unescaped(text))
    bare = F.regexp_replace(whole, r'"[^"]*+(?:"|\z)', "")
    return _count(bare, "{[") - _count(bare, "}]")


def depths(raw: DataFrame) -> DataFrame:
    """``raw`` chunks as source_path, line_no, text, closed, inside, before, after.

    ``inside``: the chunk begins in a string; ``before`` and ``after``: depth of brackets at its begin and after the
    brace that ends it. ``closed`` is false for what follows a file's last brace.
    """
    sizes = raw.groupBy("source_path").agg(
        (F.sum(F.octet_length("bytes") + 1) <= F.max("file_size_bytes")).alias("whole"),
        F.count("*").alias("n"),
    )
    numbered = with_line_numbers(raw).join(encodings(raw), "source_path").join(sizes, "source_path")
    start = F.regexp_replace(decoded(), r"^[^\[{]*+", "")
    numbered = numbered.withColumn("text", F.when(F.col("line_no") == 0, start).otherwise(decoded()))
    numbered = numbered.withColumn("closed", F.col("whole") | (F.col("line_no") < F.col("n") - 1))
    flips = _count(_unescaped(F.col("text")), '"') % 2
    told = numbered.select("source_path", "block", "line_no", "text", "closed", flips.alias("flips")).withColumns(
        {
            "from_out": _net(F.col("text"), F.lit(False)) - (F.col("closed") & (F.col("flips") == 0)).cast("int"),
            "from_in": _net(F.col("text"), F.lit(True)) - (F.col("closed") & (F.col("flips") == 1)).cast("int"),
        }
    )
    earlier = Window.partitionBy("source_path", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    swapped = told.withColumn("swaps", F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2)
    even = F.col("swaps") == 0
    both = swapped.withColumns(
        {"step0": F.when(even, F.col("from_out")).otherwise(F.col("from_in")),
         "step1": F.when(even, F.col("from_in")).otherwise(F.col("from_out"))}
    )
    both = both.withColumns(
        {f"upto{s}": F.coalesce(F.sum(f"step{s}").over(earlier), F.lit(0)) for s in (0, 1)}
    )
    # Written before the blocks' totals are taken, as every text would be read, and its brackets counted, once more for them.
    both = written(both.select("source_path", "block", "line_no", "text", "closed", "flips", "swaps", "step0", "step1", "upto0", "upto1"))
    totals = both.groupBy("source_path", "block").agg(*[F.sum(c).alias(f"all_{c}") for c in ("flips", "step0", "step1")])
    blocks = Window.partitionBy("source_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = totals.withColumn("start", F.coalesce(F.sum("all_flips").over(blocks), F.lit(0)) % 2)
    begun = begun.withColumn("step", F.when(F.col("start") == 0, F.col("all_step0")).otherwise(F.col("all_step1")))
    begun = begun.select(
        "source_path", "block", "start", F.coalesce(F.sum("step").over(blocks), F.lit(0)).alias("depth")
    )
    begun = broadcast_if_small(written(begun))
    first = F.col("start") == 0
    before = F.col("depth") + F.when(first, F.col("upto0")).otherwise(F.col("upto1"))
    return both.join(begun, ["source_path", "block"]).select(
        "source_path", "block", "line_no", "text", "closed",
        (F.col("swaps") != F.col("start")).alias("inside"), before.alias("before"),
        (before + F.when(first, F.col("step0")).otherwise(F.col("step1"))).alias("after"),
    )


def elements(raw: DataFrame, key: str | None = None) -> DataFrame:
    """(source_path, place, element): objects of the array that a document is, or that its ``key`` holds, in order.

    ``place`` is the number of the element's first chunk. An array that is the document yields nothing unless it
    begins with an object, and what is not an object stays in the element after it, which then does not parse; in the
    array of a key (in any case), scalars are passed over. One row with ``element`` null stands for a document whose brackets
    do not match or that goes on after its array. A key of that name deeper down is none of the document. What comes
    before the first bracket of a file is left out.
    """
    scanned = written(depths(raw))
    top, name, scalars = 1, "", ""
    if key is not None:
        top, name, scalars = 2, rf'(?<!\\)"(?i:\Q{key}\E)"\s*+:\s*+', SCALAR
    skipped = rf"(?:{scalars}\s*+,\s*+)*+" if scalars else ""
    begun = r'(?=\{|"[^"]*+\z)' if scalars else r"(?=\{)"
    found = rf"(?s)^({'.*?' if key else ''}){name}\[\s*+{skipped}{begun}"
    prefix = F.regexp_extract("text", found, 1)
    state = (F.col("inside").cast("int") + _count(_unescaped(prefix), '"')) % 2
    opens = F.col("text").rlike(found) & (state == 0) & (F.col("before") + _net(prefix, F.col("inside")) == top - 1)
    if key is None:
        opens = opens & (F.col("line_no") == 0)
    marked = scanned.withColumn("opens", F.coalesce(opens, F.lit(False)))
    first = marked.filter("opens").groupBy("source_path").agg(F.min("line_no").alias("first"))
    within = marked.join(first, "source_path").filter("line_no >= first")
    level = (F.col("before") == top) & (F.col("line_no") > F.col("first"))
    between = level & ~F.col("inside")
    more = rf"(?:\s*+,\s*+{scalars})*+" if scalars else ""
    resumed = F.when(F.col("inside"), F.concat(F.lit(',"'), "text")).otherwise(F.col("text"))
    shut = level & resumed.rlike(rf"^{more}\s*+\]")
    last = within.filter(shut).groupBy("source_path").agg(
        F.min("line_no").alias("last"), F.min_by("text", "line_no").alias("tail")
    )
    within = within.join(last, "source_path").filter("line_no < last")
    starts = (F.col("line_no") == F.col("first")) | between
    piece = F.when(F.col("line_no") == F.col("first"), F.regexp_replace("text", found, "")).otherwise(F.col("text"))
    within = within.select(
        "source_path", "block", "line_no", piece.alias("text"), F.when(starts, F.col("line_no")).alias("started")
    )
    upto = Window.partitionBy("source_path", "block").orderBy("line_no")
    blocks = Window.partitionBy("source_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = within.groupBy("source_path", "block").agg(F.max("started").alias("latest")).select(
        "source_path", "block", F.max("latest").over(blocks).alias("carried")
    )
    placed = within.withColumn("started", F.last("started", ignorenulls=True).over(upto)).join(
        carried, ["source_path", "block"]
    )
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"])
    cut = placed.groupBy("source_path", F.coalesce("started", "carried").alias("place")).agg(
        F.regexp_replace(
            F.concat(F.array_join(pieces, SEPARATOR), F.lit(SEPARATOR)), rf"^(?:\s*+,)?+\s*+{skipped}", ""
        ).alias("element")
    )
    ends = scanned.groupBy("source_path").agg(
        F.max_by("after", "line_no").alias("depth"), F.max("line_no").alias("final")
    )
    ended = F.col("depth") == 0
    if key is None:
        alone = (F.col("final") == F.col("last")) & F.col("tail").rlike(r"^\s*+\]\s*+\z")
        ended = ended & F.coalesce(alone, F.lit(True))
    broken = ends.join(last, "source_path", "left").filter(~ended).select("source_path")
    wrong = broken.select("source_path", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("string").alias("element"))
    return cut.join(broken, "source_path", "left_anti").unionByName(wrong)


def outcomes(cut: DataFrame) -> DataFrame:
    """Per document of ``cut`` elements: ``broken`` (see there), or ``whole`` when some element is no object that parses.

    A ``whole`` document has to be read as one value, one that is neither is done with its elements.
    """
    fits = F.schema_of_variant(F.try_parse_json("element")).startswith("OBJECT")
    found = cut.groupBy("source_path").agg(
        (~F.bool_and(F.coalesce(fits, F.lit(False)))).alias("whole"), F.bool_or(F.col("element").isNull()).alias("broken")
    )
    return found.select("source_path", (F.col("whole") & ~F.col("broken")).alias("whole"), "broken")

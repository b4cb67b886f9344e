"""CSV records over lines and blocks: quoted line breaks and stray quotes, without a file in one task.

A line either begins outside of quotes or inside a quoted field, and tells for both cases how it ends: four
possible maps. Maps of consecutive lines compose, so each block of a file is one map as well; a prefix scan over a
file's few blocks gives the state in which each begins, and one within each block the state of its lines.
A line that begins outside of quotes begins a record.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.sources.files import with_line_numbers
from ratelens.sources.tables import written


def ends_inside(text: Column, delimiter: str) -> Column:
    """Whether a line that begins outside of quotes ends inside a quoted field.

    Only a quote at the start of a field opens it; a doubled quote is none; what follows a closing quote
    belongs to the field. So quotes elsewhere (5" catheter) count for nothing.
    """
    mark = f"\\{delimiter}" if delimiter in "|;," else delimiter
    closed = f'(?<=^|{mark})"[^"]*+(?:""[^"]*+)*+"'
    return text.contains('"') & F.regexp_replace(text, closed, "x").rlike(f'(?:^|{mark})"')


def line_maps(lines: DataFrame, delimiters) -> DataFrame:
    """``lines`` (bytes, delimiter) with ``from_out`` and ``from_in``: how the line ends, 1 for inside quotes."""

    def end(text: Column) -> Column:
        out = F.lit(False)
        for mark in delimiters:
            out = F.when(F.col("delimiter") == mark, ends_inside(text, mark)).otherwise(out)
        return out.cast("int")

    quoted = F.col("bytes").contains('"')
    return lines.withColumns(
        {
            "from_out": F.when(quoted, end(F.col("bytes"))).otherwise(0),
            "from_in": F.when(quoted, end(F.concat(F.lit('"'), F.col("bytes")))).otherwise(1),
        }
    )


def composed(rows: DataFrame, by: list, order: str) -> DataFrame:
    """``from_out`` and ``from_in`` of every row replaced by those of all rows of ``by`` up to it.

    The last row whose end does not depend on its start decides, and how often the state was swapped since.
    """
    upto = Window.partitionBy(*by).orderBy(order)
    swaps = F.sum(((F.col("from_out") == 1) & (F.col("from_in") == 0)).cast("int")).over(upto)
    reset = F.last(
        F.when(F.col("from_out") == F.col("from_in"), F.struct(F.col("from_out").alias("end"), "swaps")),
        ignorenulls=True,
    ).over(upto)

    def end(start: int) -> Column:
        known = (F.col("reset.end") + F.col("swaps") - F.col("reset.swaps")) % 2
        return F.coalesce(known, (F.lit(start) + F.col("swaps")) % 2)

    found = rows.withColumn("swaps", swaps).withColumn("reset", reset)
    return found.withColumns({"from_out": end(0), "from_in": end(1)}).drop("swaps", "reset")


def numbered(lines: DataFrame) -> DataFrame:
    """``lines`` (source_path, block, line_no, bytes, from_out, from_in) with the number of the record of each.

    A quote that is never closed is a stray one: from its line on, every line is a record by itself.
    Each step is written once, as the next reads it several times: as a plan alone the first scan ran a dozen times.
    """
    within = Window.partitionBy("source_path", "block").orderBy("line_no")
    before = Window.partitionBy("source_path").orderBy("block")
    scanned = composed(lines, ["source_path", "block"], "line_no")
    last = F.max_by(F.struct("from_out", "from_in"), "line_no").alias("map")
    blocks = scanned.groupBy("source_path", "block").agg(last).select("source_path", "block", "map.*")
    begins = composed(blocks, ["source_path"], "block").select(
        "source_path", "block", F.lag("from_out", 1, 0).over(before).alias("begins")
    )
    ends = F.when(F.col("begins") == 1, F.col("from_in")).otherwise(F.col("from_out"))
    states = scanned.join(begins, ["source_path", "block"]).withColumn("ends", ends)
    starts = F.when(F.lag("ends").over(within).isNull(), F.col("begins")).otherwise(F.lag("ends").over(within))
    kept = ["source_path", "block", "line_no", "bytes", "ends"]
    states = written(states.select(*kept, (1 - starts).alias("starts")))
    counts = states.groupBy("source_path", "block").agg(F.sum("starts").alias("n"))
    earlier = F.coalesce(F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("source_path", "block", earlier.alias("earlier"))
    record = (F.col("earlier") + F.sum("starts").over(within) - 1).alias("record")
    placed = written(
        states.join(offsets, ["source_path", "block"]).select("source_path", "line_no", "bytes", "ends", record)
    )
    tail = placed.groupBy("source_path").agg(F.max_by(F.struct("ends", "record"), "line_no").alias("tail"))
    stray = F.col("tail.ends").eqNullSafe(1) & (F.col("record") == F.col("tail.record"))
    first = placed.join(tail, "source_path").filter(stray).groupBy("source_path").agg(
        F.max("record").alias("stray"), F.min("line_no").alias("stray_line")
    )
    apart = F.col("record") + F.when(F.col("record") == F.col("stray"), F.col("line_no") - F.col("stray_line")).otherwise(0)
    return placed.join(first, "source_path", "left").select(
        "source_path", "line_no", "bytes", F.coalesce(apart, "record").alias("record")
    )


def records(raw: DataFrame, profile: DataFrame, delimiters) -> DataFrame:
    """(source_path, line_no, bytes) of every record of the files of ``profile`` (source_path, delimiter).

    ``line_no`` counts records from 0; lines of a record are joined by a line feed. Files without an open quote
    at the end of any line, the usual ones, stay as they are and are not shuffled for it. Only the lines of one
    record meet in one row.
    """
    marks = profile.select("source_path", "delimiter")
    lines = with_line_numbers(raw).select("source_path", "block", "line_no", "bytes")
    mapped = written(line_maps(lines.join(marks, "source_path"), delimiters))
    broken = mapped.filter("from_out = 1").select("source_path").distinct()
    whole = mapped.join(broken, "source_path", "left_anti")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "bytes"))), lambda x: x["bytes"])
    joined = (
        numbered(mapped.join(broken, "source_path", "left_semi"))
        .groupBy("source_path", "record")
        .agg(F.array_join(texts, "\n").alias("bytes"))
        .select("source_path", F.col("record").alias("line_no"), "bytes")
    )
    return whole.select("source_path", "line_no", "bytes").unionByName(joined)

"""Exact medians of groups of any size."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per doubling of the value: fine enough to split a hot group into many small ones.
STEPS_PER_DOUBLING = 32


def _bucket(value: Column) -> Column:
    """A bucket that never decreases as the value grows."""
    step = F.floor(F.log2(F.greatest(F.abs(value), F.lit(1e-9))) * STEPS_PER_DOUBLING)
    shifted = step + F.lit(1000 * STEPS_PER_DOUBLING)
    return F.when(value > 0, shifted).when(value < 0, -shifted).otherwise(F.lit(0))


# Rows from which on a group is not sorted by one task. At most rows / HOT_GROUP groups are that large.
HOT_GROUP = 200_000
# Classes of groups, by hash, that are counted to find large ones.
CLASSES = 1 << 16


def by_size(
    rows: DataFrame, keys: list[str], hot: int = HOT_GROUP, among: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose group is small, and the others. Every group of ``hot`` rows and more is among the others.

    Rows are counted by classes of their group's hash, of which a task has a bounded number; a class of ``hot`` rows is
    taken whole, whatever groups it holds. ``among`` is what is counted instead of ``rows``, where that costs less.
    """
    mark = F.pmod(F.xxhash64(*keys), F.lit(CLASSES)).cast("int")
    counted = (rows if among is None else among).groupBy(mark.alias("_class")).agg(F.count("*").alias("_n"))
    large = F.broadcast(counted.filter(F.col("_n") >= hot).select("_class"))
    marked = rows.withColumn("_class", mark)
    return marked.join(large, "_class", "left_anti").drop("_class"), marked.join(large, "_class", "left_semi").drop("_class")


# One charge in so many is counted where partial results save time, not memory.
COUNTED = 16


def counted_charges(rates: DataFrame, hot: int = HOT_GROUP) -> tuple[DataFrame, int]:
    """Rates to count instead of all, and from how many of them on a group is large. It only decides on a route."""
    if "standard_charge_sk" not in rates.columns:
        return rates, hot
    return rates.filter(F.pmod(F.xxhash64("standard_charge_sk"), F.lit(COUNTED)) == 0), hot // COUNTED // 2


def exact_summary(
    df: DataFrame, keys: list[str], value: str, latest: str | None = None, hot: int = HOT_GROUP
) -> DataFrame:
    """Count, minimum, maximum and median of ``value`` per group that has one.

    Rows of a group are brought together by one shuffle of the columns that are used, and ranked there. Groups of
    ``hot`` rows and more are found beforehand (``by_size``); they go through value buckets
    (``_bucketed_summary``), so that no hot group is sorted in one task.  ``latest`` adds the maximum of that column.
    """
    rows = valued(df, keys, value, latest)
    if not keys:
        return _bucketed_summary(rows, keys)
    usual, rest = by_size(rows, keys, hot)
    return summarised(usual, rest, keys)


def valued(df: DataFrame, keys: list[str], value: str, latest: str | None = None) -> DataFrame:
    """Rows that have a value: the keys, ``_value`` and ``_latest``."""
    newest = F.col(latest) if latest else F.lit(None)
    return df.select(*keys, (F.col(value).cast("double") + F.lit(0.0)).alias("_value"), newest.alias("_latest")).filter("_value is not null")


def summarised(usual: DataFrame, large: DataFrame, keys: list[str]) -> DataFrame:
    """The summary of ``valued`` rows, told apart by whether a task can sort their groups."""
    return _ranked_summary(usual, keys).unionByName(_bucketed_summary(large, keys))


def _ranked_summary(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The summary of groups that a task can sort: every step runs where the one shuffle by key put the rows."""
    amount = F.col("_value")
    in_order = Window.partitionBy(*keys).orderBy("_value")
    whole = Window.partitionBy(*keys)
    at = F.col("_at")
    return (
        rows.withColumns({"_at": F.row_number().over(in_order), "_total": F.count("*").over(whole)})
        .groupBy(*keys)
        .agg(
            F.count("*").alias("row_count"),
            F.min("_value").alias("lowest"),
            F.max("_value").alias("highest"),
            (
                (F.min(F.when(at == F.expr("(_total + 1) div 2"), amount))
                 + F.min(F.when(at == F.expr("(_total + 2) div 2"), amount))) / 2
            ).alias("median"),
            F.max("_latest").alias("latest"),
        )
    )


def _bucketed_summary(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The summary of groups of any size.

    Equal values are counted before anything is compared.  Group totals per value bucket then tell
    which bucket holds the middle ranks, and only that bucket is ordered.
    """
    amount = F.col("_value")
    counted = (
        rows.groupBy(*keys, "_value")
        .agg(F.count("*").alias("_n"), F.max("_latest").alias("_latest"))
        .withColumn("_bucket", _bucket(amount))
    )
    along = Window.partitionBy(*keys).orderBy("_bucket")
    whole = Window.partitionBy(*keys)
    buckets = (
        counted.groupBy(*keys, "_bucket")
        .agg(
            F.sum("_n").alias("_in"),
            F.min("_value").alias("_least"),
            F.max("_value").alias("_most"),
            F.max("_latest").alias("_newest"),
        )
        .withColumns(
            {
                "_upto": F.sum("_in").over(along.rowsBetween(Window.unboundedPreceding, 0)),
                "_total": F.sum("_in").over(whole),
                "_least": F.min("_least").over(whole),
                "_most": F.max("_most").over(whole),
                "_newest": F.max("_newest").over(whole),
            }
        )
        .withColumns(
            {
                "_low": F.expr("(_total + 1) div 2"),
                "_high": F.expr("(_total + 2) div 2"),
                "_before": F.col("_upto") - F.col("_in"),
            }
        )
        .filter("_upto >= _low and _before < _high")
    )
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"b.{k}")) for k in (*keys, "_bucket")]
    middle = (
        counted.alias("c")
        .join(buckets.alias("b"), same)
        .select(
            *[f"c.{k}" for k in (*keys, "_bucket", "_value", "_n", "_latest")],
            "_before", "_low", "_high", "_total", "_least", "_most", "_newest",
        )
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy("_value")
    rank = F.col("_before") + F.sum("_n").over(within.rowsBetween(Window.unboundedPreceding, 0))
    low = F.min(F.when(F.col("_rank") >= F.col("_low"), amount))
    high = F.min(F.when(F.col("_rank") >= F.col("_high"), amount))
    # Reading ``_latest`` on both sides of the join keeps them the same plan, which runs once.
    return (
        middle.withColumn("_rank", rank)
        .groupBy(*keys)
        .agg(
            F.max("_total").alias("row_count"),
            F.min("_least").alias("lowest"),
            F.max("_most").alias("highest"),
            ((low + high) / 2).alias("median"),
            F.max(F.greatest("_newest", "_latest")).alias("latest"),
        )
    )


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """Median of ``value`` per group, one row per group that has a value."""
    return exact_summary(df.select(*keys, value), keys, value).select(
        *keys, F.col("median").alias(name)
    )


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys that may be NULL; the keys of the left side are kept."""
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    added = [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), same, how).select("l.*", *added)

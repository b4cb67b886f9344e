"""Small helpers shared by reports."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row frames side by side, without a cross join."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def distinct_count(df: DataFrame, column, name: str) -> DataFrame:
    """Distinct values as rows, then a count: each value is met once, whatever its frequency."""
    value = F.col(column) if isinstance(column, str) else column
    values = df.select(value.alias("_value")).filter("_value is not null").distinct()
    return values.agg(F.count("*").alias(name))


def at_least_one(limit: int) -> int:
    """The limit a caller asks for, honoured however large."""
    return max(1, int(limit))

"""Reading tables so that every core has work."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.session import shared_folder

SPLIT_BYTES = 128 * 1024 * 1024


def planned_bytes(df: DataFrame) -> int:
    """Size Spark plans with; for a plain scan that of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread a table too small to give every core a split; larger ones stay as they are.

    A file with one row group is read by one task however many cores wait for it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if planned_bytes(df) >= cores * SPLIT_BYTES:
        return df
    return df.repartition(cores, *keys)


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, for a frame that several branches read.

    Branches that read different columns don't share a shuffle: each would compute the frame anew.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, tempfile.gettempdir())
    path = os.path.join(folder, f"ratelens-{uuid.uuid4().hex}")
    # Half of what is written are hashes as text, which only an entropy coder makes smaller.
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows of a few columns that every executor can hold beside its work.
BROADCAST_ROWS = 1_000_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written lookup, marked for broadcast when it holds few rows; larger ones are left to Spark.

    The adaptive plan learns a lookup's size only when the rows it meets are shuffled already.
    """
    return F.broadcast(df) if is_small(df, rows) else df


def read_table(spark: SparkSession, path: str, *spread_by: str) -> DataFrame:
    """A Parquet table, spread over the cores by ``spread_by`` when it is small."""
    df = spark.read.parquet(path)
    return spread(df, *spread_by) if spread_by else df

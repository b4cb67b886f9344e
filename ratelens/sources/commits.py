"""Runs that become visible at once: rows first, one commit row last.

Every attempt of a run writes to folders of its own (``<table>/attempt=<name>``) and its commit row after all of
them, so no reader meets half a run, no rerun overwrites what is being read, and a crash between any two writes
leaves rows that nobody sees. Where several committed attempts hold a file, the newest one counts.
"""

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.sources import sinks

COMMIT = T.StructType(
    [
        T.StructField("attempt", T.StringType(), False),
        T.StructField("run_id", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)


def new_attempt() -> str:
    """A folder name no other attempt has; its first letter keeps Spark from reading it as a number."""
    return f"a{uuid.uuid4().hex}"


def write(df: DataFrame, lake: str, table: str, attempt: str) -> None:
    """One attempt's rows of a table; they stay unseen until the attempt is committed."""
    df.write.mode("overwrite").parquet(f"{lake}/{table}/attempt={attempt}")


def commit(spark: SparkSession, lake: str, attempt: str, run_id: str) -> None:
    """Make an attempt visible: one row in one file, which appears whole or not at all."""
    row = spark.range(1).select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("committed_at"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{lake}/_commits/attempt={attempt}")


def committed(spark: SparkSession, lake: str) -> DataFrame:
    """One row per committed attempt."""
    return sinks.read_or_empty(spark, f"{lake}/_commits", COMMIT).select(*COMMIT.fieldNames())


def newest_attempts(owners: DataFrame, commits: DataFrame) -> DataFrame:
    """The newest committed attempt of every file, from (source_file_name, attempt) of all attempts."""
    order = Window.partitionBy("source_file_name").orderBy(F.desc("committed_at"), F.desc("attempt"))
    ranked = owners.distinct().join(commits, "attempt").withColumn("_rank", F.row_number().over(order))
    return ranked.filter("_rank = 1").select("source_file_name", "attempt")


def read(
    spark: SparkSession, lake: str, table: str, schema: T.StructType, registries: Sequence[str]
) -> DataFrame:
    """Rows of a table from committed attempts, of each file the newest attempt that registered it.

    ``registries`` are the tables with a row per file. They and the commits are small next to the rows, so Spark
    prunes the attempts' folders and joins the rest by what it knows of their size.
    """
    keyed = T.StructType([*schema.fields, T.StructField("attempt", T.StringType())])
    names = T.StructType([T.StructField(n, T.StringType()) for n in ("source_file_name", "attempt")])
    owners = [
        sinks.read_or_empty(spark, f"{lake}/{name}", names).select("source_file_name", "attempt") for name in registries
    ]
    known = owners[0]
    for other in owners[1:]:
        known = known.unionByName(other)
    rows = sinks.read_or_empty(spark, f"{lake}/{table}", keyed)
    newest = newest_attempts(known, committed(spark, lake))
    return rows.join(newest, ["source_file_name", "attempt"], "left_semi").drop("attempt")

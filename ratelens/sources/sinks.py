"""Tables on shared storage: partitioned writes, appends, exports and reads of them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ratelens.operators.facts import newer_charges
from ratelens.schemas import MANIFEST

EXPORTED = ("dim_hospital", "dim_procedure", "dim_payer", "fct_standard_charges_semantic")
CLUSTERED_BY = ("hospital_id", "billing_code", "payer_name")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written; anything but a missing path or an empty folder is raised."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table, or an empty frame of its schema when nothing was written yet."""
    return spark.read.parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def append(df: DataFrame, path: str, *partition_by: str) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, *partition_by: str) -> None:
    """Replace exactly the partitions the frame has rows for, so that a rerun does not double."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def overwrite_day(df: DataFrame, path: str, column: str, day: str) -> None:
    """Replace one partition by the frame's rows, also when it has none."""
    df.drop(column).write.mode("overwrite").parquet(f"{path}/{column}={day}")


def read_bronze(spark: SparkSession, lake: str, ingest_date: str) -> DataFrame | None:
    """Bronze rows of one day from both source kinds by column name; None when there are none.

    Only files that the manifest calls loaded that day count: rows of a run that broke off before its manifest are
    not read, under whatever day it is repeated.
    """
    frames = []
    done = read_or_empty(spark, f"{lake}/manifest", MANIFEST).filter(
        (F.col("status") == "SUCCESS") & (F.col("ingest_date").cast("string") == ingest_date)
    )
    for folder, system in (("pt_csv", "csv_tall"), ("pt_json", "json")):
        path = f"{lake}/bronze/{folder}"
        if exists(spark, path):
            rows = (
                spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", True)
                .parquet(path)
                .withColumn("ingest_date", F.col("ingest_date").cast("string"))
                .filter(F.col("ingest_date") == ingest_date)
            )
            rows = rows.join(done.select("file_hash"), "file_hash", "left_semi")
            frames.append(rows.withColumn("_source_system", F.lit(system)))
    if not frames:
        return None
    first, *others = frames
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def read_silver(spark: SparkSession, lake: str) -> DataFrame:
    """All good rates, whatever columns a day's files have."""
    rows = spark.read.option("mergeSchema", True).parquet(f"{lake}/silver/standard_charges")
    return rows.withColumn("ingest_date", F.col("ingest_date").cast("string"))


def export_marts(marts, folder: str) -> DataFrame:
    """Write the published marts as Parquet and headered CSV; returns the rows per relation."""
    spark = marts.base.sparkSession
    counts = []
    for name in EXPORTED:
        getattr(marts, name).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        written = spark.read.parquet(f"{folder}/{name}.parquet")
        written.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")
        counts.append(
            written.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("relation"), "row_count"
            )
        )
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def read_export(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """An exported relation: Parquet when there, else CSV, else empty."""
    try:
        return spark.read.parquet(f"{folder}/{name}.parquet")
    except AnalysisException:
        pass
    try:
        return spark.read.schema(schema).option("header", True).csv(f"{folder}/{name}.csv")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def save_result(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A query result as headered CSV or as JSON lines."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "json":
        writer.json(path)
    else:
        raise ValueError(f"unknown result format: {kind}")


def _day(column: str = "ingested_at") -> Column:
    return F.to_date(column).alias("ingest_day")


def write_charges(charges: DataFrame, path: str) -> None:
    """The charge fact by day of load, sorted inside files by the columns reports filter on."""
    dated = charges.withColumn("ingest_day", _day())
    overwrite_partitions(
        dated.sortWithinPartitions("ingest_day", *CLUSTERED_BY), path, "ingest_day"
    )


def merge_charges(path: str, base: DataFrame, hospitals: DataFrame, staging: str) -> None:
    """Upsert base rows newer than the table by charge key, rewriting only the days concerned.

    A row may come back under another day, so days are taken from both the new rows and the rows
    they replace.  The new contents are written beside the table first: readers never meet a
    half-written day, and a lost executor does not repeat the comparison.
    """
    spark = base.sparkSession
    target = spark.read.parquet(path)
    newest = target.agg(F.max("ingested_at")).first()[0]  # one value
    fresh = newer_charges(base, newest, hospitals).withColumn("ingest_day", _day())
    fresh.write.mode("overwrite").parquet(f"{staging}/fresh")
    fresh = spark.read.parquet(f"{staging}/fresh")
    keys = fresh.select("standard_charge_sk")
    replaced = target.join(keys, "standard_charge_sk", "left_semi")
    days = fresh.select("ingest_day").union(replaced.select("ingest_day")).distinct()
    # One row per calendar day: a few thousand at most.
    kept = target.join(F.broadcast(days), "ingest_day", "left_semi").join(
        keys, "standard_charge_sk", "left_anti"
    )
    columns = fresh.columns
    merged = kept.select(*columns).unionByName(fresh)
    merged.write.mode("overwrite").parquet(f"{staging}/merged")
    merged = spark.read.parquet(f"{staging}/merged")
    left_over = days.join(merged.select("ingest_day").distinct(), "ingest_day", "left_anti")
    emptied = [row[0] for row in left_over.collect()]  # calendar days
    overwrite_partitions(
        merged.sortWithinPartitions("ingest_day", *CLUSTERED_BY), path, "ingest_day"
    )
    for day in emptied:  # a day that lost its last row; replacing partitions cannot empty one
        overwrite_day(merged.limit(0), path, "ingest_day", str(day or "__HIVE_DEFAULT_PARTITION__"))

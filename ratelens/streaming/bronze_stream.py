"""Incremental load of NDJSON drops: the same rate rules, the checkpoint in place of the manifest."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratelens.operators import silver
from ratelens.session import configure
from ratelens.sources import sinks

# Fields of a flat record the rate rules look at, as text.
FIELDS = (
    "billing_code", "code", "description", *silver.PAYER_KEYS, *silver.PLAN_KEYS,
    *silver.TABULAR_RATES,
)


def parsed_lines(lines: DataFrame, ingest_date: str) -> DataFrame:
    """Bronze rows of NDJSON lines."""
    schema = ", ".join(f"{name} string" for name in FIELDS)
    return lines.select(
        F.col("_metadata.file_path").alias("source_path"),
        F.from_json("value", schema).alias("r"),
    ).select(
        "source_path",
        "r.*",
        F.lit(ingest_date).alias("ingest_date"),
        F.lit("json").alias("source_format"),
        F.lit("json").alias("_source_system"),
    )


def _write_batch(lake: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        """Both tables of a micro-batch; a repeated batch replaces what it wrote before."""
        tagged = batch.withColumn("batch", F.lit(batch_id)).persist()
        good = tagged.filter("reason_code is null").drop("reason_code")
        bad = tagged.filter("reason_code is not null")
        sinks.overwrite_partitions(good, f"{lake}/stream/standard_charges", "ingest_date", "batch")
        sinks.overwrite_partitions(bad, f"{lake}/stream/quarantine", "ingest_date", "batch")
        tagged.unpersist()

    return write


def load_available(
    spark: SparkSession, drop: str, lake: str, ingest_date: str, checkpoint: str
) -> StreamingQuery:
    """Load every file that arrived since the last run, then stop."""
    configure(spark)
    lines = (
        spark.readStream.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{json,ndjson}")
        .text(drop)
    )
    rates = silver.tabular_rates(parsed_lines(lines, ingest_date))
    return (
        rates.writeStream.foreachBatch(_write_batch(lake))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

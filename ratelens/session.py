"""Session settings the jobs rely on."""

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else made."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "ratelens", cpus: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder all executors see, as the cluster names it; ``fallback`` only where unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return folder.rstrip("/")

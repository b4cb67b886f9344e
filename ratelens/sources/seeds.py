"""Editable seed maps from payer and plan names to families."""

import csv
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PAYER_MAP = "payer_name_norm string, payer_family string"
PLAN_MAP = "payer_family string, plan_name_norm string, plan_family string"
SHIPPED = Path(__file__).resolve().parent.parent / "seeds"


def _load(spark: SparkSession, path: str | None, shipped: str, schema: str) -> DataFrame:
    if path:
        return spark.read.schema(schema).option("header", True).csv(path)
    # The shipped map is a file of this package, which executors do not have; it is a few rows.
    with open(SHIPPED / shipped, newline="", encoding="utf-8") as handle:
        rows = [tuple(row.values()) for row in csv.DictReader(handle)]
    return spark.createDataFrame(rows, schema)


def payer_map(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The shipped payer map, or an edited copy at ``path``."""
    return _load(spark, path, "payer_map.csv", PAYER_MAP)


def plan_map(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The shipped plan map, or an edited copy at ``path``."""
    return _load(spark, path, "plan_map.csv", PLAN_MAP)

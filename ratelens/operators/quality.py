"""Checks on built tables.  Each returns the rows that violate it, so an empty frame passes.

``check_run`` runs any number of them over one scan of a table and returns how many violations each has.
"""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions.codes import HARD_FORMATS, code_issue, code_type_norm, validation_code
from ratelens.operators.median import HOT_GROUP, by_size, counted_charges
from ratelens.schemas import CONTRACT_COLUMNS
from ratelens.sources.tables import broadcast_if_small, written


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Columns that hold NULLs, with how many; all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "null_rows").filter("null_rows > 0")


def unique(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )


def accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_records"))
    return counted.filter(~F.col("value").isin(*values))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values that the parent does not hold.  Distinct values meet, not rows."""
    values = df.select(F.col(column).alias("value")).filter("value is not null")
    known = parent.select(F.col(parent_column).alias("value")).distinct()
    return values.distinct().join(known, "value", "left_anti")


def not_empty(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).filter("row_count = 0").select(
        F.lit(name).alias("empty_table")
    )


def code_formats(procedures: DataFrame) -> DataFrame:
    """Codes of the strictly checked types that do not have the type's format."""
    kind = code_type_norm("billing_code_type")
    checked = procedures.withColumn(
        "normalized_billing_code", validation_code("billing_code", "billing_code_type")
    )
    broken = [
        (kind == name) & ~F.col("normalized_billing_code").rlike(pattern)
        for name, pattern in HARD_FORMATS.items()
    ]
    return checked.filter(reduce(lambda a, b: a | b, broken)).select(
        "billing_code", "billing_code_type", "normalized_billing_code"
    )


def unknown_share(procedures: DataFrame, threshold: float = 0.95) -> DataFrame:
    """A row when this share of procedures or more has no known type."""
    counted = procedures.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("billing_code_type") == "UNKNOWN").alias("unknown_count"),
    )
    return counted.filter(
        (F.col("total") > 0) & (F.col("unknown_count") >= F.col("total") * F.lit(threshold))
    )


class Reference(NamedTuple):
    """``column`` must be NULL or a value of ``key`` in ``parent``."""

    column: str
    parent: DataFrame
    key: str


def no_nulls(*columns: str) -> dict[str, Column]:
    """Row checks for ``check_run``: the columns hold no NULL."""
    return {f"not_null {c}": F.col(c).isNull() for c in columns}


def only_values(column: str, values) -> dict[str, Column]:
    """Row check for ``check_run``: the column is NULL or one of the values."""
    return {f"accepted_values {column}": F.col(column).isNotNull() & ~F.col(column).isin(*values)}


def check_run(df: DataFrame, table: str, rows: dict[str, Column], unique=(), references=()) -> DataFrame:
    """(table_name, check_name, violations): one row per check, over one scan of the table.

    ``rows`` maps a check to the condition of a violating row. Of a ``unique`` column the values held more than once
    count. References count rows without a parent; each parent's distinct keys meet the rows in a join. A table
    without rows violates ``not_empty``. Values of unique columns are counted beside the row checks: a row goes into
    one aggregation once, and once more for each unique column after the first.
    """
    checks = dict(rows)
    for i, (column, parent, key) in enumerate(references):
        keys = parent.select(F.col(key).alias(column)).filter(F.col(column).isNotNull()).distinct()
        # Written first, so that few keys are sent to the rows instead of shuffling every row.
        keys = broadcast_if_small(written(keys))
        df = df.join(keys.withColumn(f"_known{i}", F.lit(True)), column, "left")
        checks[f"relationships {column}"] = F.col(column).isNotNull() & F.col(f"_known{i}").isNull()
    flags = {f"_c{i}": F.coalesce(condition, F.lit(False)).cast("long") for i, condition in enumerate(checks.values())}
    kept = {f"_u{i}": F.col(c).cast("string") for i, c in enumerate(unique)}
    narrow = df.select(*[c.alias(n) for n, c in {**flags, **kept}.items()])
    sums = [F.sum(n).alias(n) for n in flags]
    if unique:
        entries = [
            F.struct(F.lit(i).alias("_at"), F.col(f"_u{i}").alias("_value"), *[
                (F.col(n) if i == 0 else F.lit(0).cast("long")).alias(n) for n in flags
            ]) for i in range(len(unique))
        ]
        by_value = (
            narrow.select(F.inline(F.array(*entries))).groupBy("_at", "_value")
            .agg(F.count("*").alias("_n"), *sums)
        )
        counted = by_value.agg(
            F.sum(F.when(F.col("_at") == 0, F.col("_n"))).alias("_rows"), *sums,
            *[F.count_if((F.col("_at") == i) & F.col("_value").isNotNull() & (F.col("_n") > 1)).alias(f"_u{i}")
              for i in range(len(unique))],
        )
    else:
        counted = narrow.agg(F.count("*").alias("_rows"), *sums)
    names = {
        "not_empty": F.when(F.coalesce("_rows", F.lit(0)) == 0, 1).otherwise(0),
        **{name: F.col(n) for name, n in zip(checks, flags)},
        **{f"unique {c}": F.col(f"_u{i}") for i, c in enumerate(unique)},
    }
    found = F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.coalesce(n.cast("long"), F.lit(0).cast("long")).alias("violations"))
        for name, n in names.items()
    ])
    return counted.select(F.lit(table).alias("table_name"), F.inline(found))


def numeric_prefixes(hospitals: DataFrame) -> DataFrame:
    """Hospitals whose cleaned name still starts with a facility id."""
    return hospitals.filter(F.trim("hospital_name_clean").rlike(r"^\d{1,3}\s+\d{5,}")).select(
        "hospital_id", "hospital_name", "hospital_name_clean", "source_file_name"
    )


def invalid_codes(**aggregates: DataFrame) -> DataFrame:
    """Invalid codes in the aggregates reports read."""
    frames = [
        df.filter(code_issue("billing_code", "billing_code_type").isNotNull()).select(
            "billing_code", "billing_code_type", F.lit(name).alias("agg_name")
        )
        for name, df in aggregates.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def other_category(aggregate: DataFrame) -> DataFrame:
    return aggregate.filter(F.lower(F.trim("rate_category")) == "other")


def landing_counts(df: DataFrame, table_name: str, *keys: str) -> DataFrame:
    """Rows and first and last load per file (and record path)."""
    return df.groupBy(F.lit(table_name).alias("table_name"), "source_file_name", *keys).agg(
        F.count("*").alias("row_count"),
        F.min("ingested_at").alias("first_ingested"),
        F.max("ingested_at").alias("last_ingested"),
    )


def sample_keys(landing: DataFrame) -> DataFrame:
    """Sorted keys of the JSON object of one landing row."""
    first = landing.orderBy("source_file_name", "ingested_at", "raw").limit(1)
    return first.select(
        "source_file_name",
        "ingested_at",
        F.array_join(F.array_sort(F.json_object_keys("raw")), ",").alias("sample_json_keys"),
    )


def first_rows(landing: DataFrame, per_file: int = 5) -> DataFrame:
    """The earliest rows of every file."""
    order = Window.partitionBy("source_file_name").orderBy("ingested_at", "raw")
    return (
        landing.select("source_file_name", "ingested_at", "raw", F.row_number().over(order).alias("rn"))
        .filter(F.col("rn") <= per_file)
        .orderBy("source_file_name", "rn")
    )


def sample_rows(df: DataFrame, *order: str, limit: int = 20) -> DataFrame:
    return df.orderBy(*order).limit(limit)


def format_counts(landing: DataFrame) -> DataFrame:
    """Rows per file format as recorded in the rows."""
    hint = F.get_json_object("raw", "$._meta_format_hint").alias("format_hint")
    return landing.groupBy(hint).agg(F.count("*").alias("row_count")).orderBy("format_hint")


def json_rows(landing: DataFrame, column: str = "raw") -> DataFrame:
    """How many rows hold valid JSON."""
    return landing.agg(
        F.count_if(F.try_parse_json(column).isNotNull()).alias("json_typed_rows")
    )


def published_counts(**tables: DataFrame) -> DataFrame:
    frames = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def missing_contract_columns(df: DataFrame) -> list[str]:
    """Columns the contract requires and the table lacks."""
    return [c for c in CONTRACT_COLUMNS if c not in df.columns]


def mixed_attributes(df: DataFrame, keys: list[str], attributes: list[str], hot: int = HOT_GROUP) -> DataFrame:
    """Groups whose rates may not be compared: an attribute that must agree has several values.

    Rates are dealt by their group once; those of a charge stand side by side and so take little room. Groups of ``hot``
    rows and more are told once a task before they are shuffled.
    """
    # The place of a value among those of its group: the last one's is how many there are, and no row is shuffled for it.
    places = {
        f"_{a}": F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.coalesce(F.col(a).cast("string"), F.lit(""))))
        for a in attributes
    }
    counts = [F.max(f"_{a}").alias(f"{a}_values") for a in attributes]
    several = reduce(lambda a, b: a | b, [F.col(f"{a}_values") > 1 for a in attributes])
    among, least = counted_charges(df, hot)
    usual, large = by_size(df.select(*keys, *attributes), keys, least, among)
    parts = [rows.distinct().withColumns(places).groupBy(*keys).agg(*counts).filter(several) for rows in (usual.repartition(*keys), large)]
    return parts[0].unionByName(parts[1])

"""Dimensions: hospitals, payers, procedures, source files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions import blank_to_null, first_present, text
from ratelens.functions.codes import code_type_norm, infer_code_type, storage_code
from ratelens.functions.keys import surrogate_key
from ratelens.functions.names import (
    STAGING_NAME_KEYS,
    clean_hospital_name,
    file_display_name,
    hospital_match_name,
    match_text,
    preamble_name,
)
from ratelens.operators.staging import latest_per_file

HOSPITAL_COLUMNS = ("hospital_id", "hospital_name", "hospital_name_clean", "hospital_name_norm")


def file_names(csv_registry: DataFrame, json_registry: DataFrame) -> DataFrame:
    """Best display name of every registered file, one row per file."""
    derived = blank_to_null(file_display_name("source_file_name"))
    stated = latest_per_file(csv_registry).select(
        "source_file_name",
        F.coalesce(preamble_name("preamble_kv"), derived, "source_file_name").alias(
            "hospital_name_clean"
        ),
    )
    unnamed = (
        json_registry.select("source_file_name")
        .distinct()
        .withColumn("hospital_name_clean", F.coalesce(derived, "source_file_name"))
    )
    return stated.unionByName(unnamed)


def _named_hospital(df: DataFrame, stated) -> DataFrame:
    """Adds the hospital columns for the stated name, or for the file name where there is none.

    Every step is a column of its own, so that no regular expression is repeated.
    """
    raw = first_present(stated, file_display_name("source_file_name"), "source_file_name")
    file_words = F.lower(F.trim("source_file_name"))
    norm = hospital_match_name("hospital_name_clean")
    return (
        df.withColumn("hospital_name", raw)
        .withColumn("_clean", clean_hospital_name("hospital_name"))
        .withColumn("hospital_name_clean", F.coalesce(blank_to_null("_clean"), "source_file_name"))
        .withColumn("_norm", norm)
        .withColumn(
            "hospital_name_norm",
            F.coalesce(blank_to_null("_norm"), F.lower(F.trim("hospital_name_clean")), file_words),
        )
        .withColumn("hospital_id", surrogate_key("hospital_name_norm"))
        .drop("_clean", "_norm")
    )


def hospital_lookup(csv_registry: DataFrame, json_registry: DataFrame) -> DataFrame:
    """Hospital of every registered file.  Names are cleaned here, once per file, not per rate."""
    names = file_names(csv_registry, json_registry).withColumnRenamed(
        "hospital_name_clean", "_stated"
    )
    return _named_hospital(names, "_stated").select("source_file_name", *HOSPITAL_COLUMNS)


def with_hospital_id(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Replace ``hospital_id`` by the one of the file; an unregistered file is its own hospital.

    ``lookup`` has one row per file, so no row is multiplied; Spark broadcasts it when its size
    allows and otherwise splits oversized files with the skew join.
    """
    ids = lookup.select("source_file_name", F.col("hospital_id").alias("_registered"))
    joined = df.drop("hospital_id").join(ids, "source_file_name", "left")
    # Words of the file name only where they are needed.
    own = F.when(F.col("_registered").isNull(), F.col("source_file_name"))
    return (
        joined.withColumn("_own", clean_hospital_name(file_display_name(own)))
        .withColumn("_own", F.when(F.col("_own") != "", F.col("_own")).otherwise(own))
        .withColumn("_own_norm", hospital_match_name("_own"))
        .withColumn(
            "hospital_id",
            F.coalesce(
                "_registered",
                surrogate_key(F.coalesce(blank_to_null("_own_norm"), F.lower(F.trim("_own")))),
            ),
        )
        .drop("_registered", "_own", "_own_norm")
    )


def dim_hospital(base: DataFrame, lookup: DataFrame) -> DataFrame:
    """One row per source file of the base."""
    files = base.groupBy("source_file_name").agg(F.min("source_system").alias("source_system"))
    known = lookup.select(
        "source_file_name", *[F.col(c).alias(f"_{c}") for c in HOSPITAL_COLUMNS]
    )
    own = _named_hospital(files, F.lit(None).cast("string"))
    return own.join(known, "source_file_name", "left").select(
        *[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) for c in HOSPITAL_COLUMNS],
        "source_system", "source_file_name",
    )


def lake_dim_hospital(base: DataFrame) -> DataFrame:
    """One row per hospital id of the lake base."""
    return base.groupBy("hospital_id").agg(
        F.min(F.coalesce("hospital_name", "hospital_name_clean")).alias("hospital_name"),
        *[
            F.min(c).alias(c)
            for c in (
                "hospital_name_clean", "hospital_name_norm", "source_system", "source_file_name",
            )
        ],
    )


def hospital_display(dim: DataFrame) -> DataFrame:
    """One display name per hospital id, for joins that must not multiply rows."""
    return dim.groupBy("hospital_id").agg(F.min("hospital_name_clean").alias("hospital_name_clean"))


def dim_payer(base: DataFrame) -> DataFrame:
    """Distinct payer and plan pairs; blanks stand for NULL."""
    return (
        base.filter(F.col("payer_name").isNotNull() | F.col("plan_name").isNotNull())
        .select(text("payer_name").alias("payer_name"), text("plan_name").alias("plan_name"))
        .distinct()
    )


def _seed(seed: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A seed map with one row per key, so that joining it never multiplies rows."""
    return seed.groupBy(*keys).agg(F.min(value).alias(value))


def with_families(df: DataFrame, payer_map: DataFrame, plan_map: DataFrame) -> DataFrame:
    """Payer and plan families of ``payer_name_norm`` / ``plan_name_norm`` by the seed maps."""
    payers = _seed(payer_map, ["payer_name_norm"], "payer_family").withColumnRenamed(
        "payer_family", "_payer"
    )
    plans = _seed(plan_map, ["payer_family", "plan_name_norm"], "plan_family").withColumnRenamed(
        "plan_family", "_plan"
    )
    return (
        df.join(payers, "payer_name_norm", "left")
        .withColumn("payer_family", F.coalesce("_payer", "payer_name_norm"))
        .join(plans, ["payer_family", "plan_name_norm"], "left")
        .withColumn("plan_family", F.coalesce("_plan", "plan_name_norm"))
        .drop("_payer", "_plan")
    )


def dim_payer_harmonized(
    payers: DataFrame, payer_map: DataFrame, plan_map: DataFrame
) -> DataFrame:
    """Every raw pair with its match form and family."""
    named = payers.select(
        F.col("payer_name").alias("payer_name_raw"),
        F.col("plan_name").alias("plan_name_raw"),
        match_text("payer_name").alias("payer_name_norm"),
        match_text("plan_name").alias("plan_name_norm"),
    )
    return with_families(named, payer_map, plan_map).select(
        "payer_name_raw", "plan_name_raw", "payer_name_norm", "plan_name_norm",
        "payer_family", "plan_family",
    )


def dim_procedure(base: DataFrame) -> DataFrame:
    """Distinct code, type and description with the type filled in and the code normalised."""
    rows = (
        base.filter(F.col("billing_code").isNotNull() | F.col("description").isNotNull())
        .select("billing_code", "billing_code_type", "description")
        .distinct()
    )
    typed = rows.select(
        text("billing_code").alias("billing_code"),
        code_type_norm(infer_code_type("billing_code", "billing_code_type")).alias(
            "billing_code_type"
        ),
        "description",
    )
    return typed.withColumn("billing_code", storage_code("billing_code", "billing_code_type"))


def dim_procedure_harmonized(semantic: DataFrame, procedures: DataFrame) -> DataFrame:
    """Most frequent description of every code and type, and how many descriptions it has."""
    key = ["billing_code", "billing_code_type"]
    by_description = (
        semantic.filter(F.col("billing_code").isNotNull())
        .select(
            "billing_code",
            F.coalesce("billing_code_type", F.lit("UNKNOWN")).alias("billing_code_type"),
            F.trim(text("description")).alias("described"),
        )
        .filter("described <> ''")
        .groupBy(*key, "described")
        .agg(F.count("*").alias("uses"))
    )
    frequent = by_description.groupBy(*key).agg(
        F.count("*").alias("description_variants_count"),
        F.min_by("described", F.struct(-F.col("uses"), F.col("described"))).alias("_described"),
    )
    listed = procedures.groupBy(
        text("billing_code").alias("billing_code"),
        F.coalesce("billing_code_type", F.lit("UNKNOWN")).alias("billing_code_type"),
    ).agg(F.max(F.trim(text("description"))).alias("_listed"))
    return listed.join(frequent, key, "left").select(
        *key,
        F.coalesce("_described", blank_to_null("_listed"), F.lit("(no description)")).alias(
            "canonical_description"
        ),
        F.coalesce("description_variants_count", F.lit(0)).alias("description_variants_count"),
    )


def dim_source_file(csv_registry: DataFrame, json_registry: DataFrame) -> DataFrame:
    """One row per file and source system over all its runs."""
    csv = csv_registry.select(
        "source_file_name",
        F.when(F.lower(F.trim("format_hint")) == "wide", "csv_wide")
        .otherwise("csv_tall")
        .alias("source_system"),
        F.coalesce(preamble_name("preamble_kv", STAGING_NAME_KEYS), "source_file_name").alias(
            "hospital_name"
        ),
        "ingested_at", "format_hint", "header_count", "delimiter", "encoding", "rows_loaded",
        "status",
    )
    json = json_registry.select(
        "source_file_name",
        F.lit("json").alias("source_system"),
        F.col("source_file_name").alias("hospital_name"),
        "ingested_at", "rows_loaded", "status",
    )
    runs = csv.unionByName(json, allowMissingColumns=True)
    return runs.groupBy("source_file_name", "source_system").agg(
        F.min("hospital_name").alias("hospital_name"),
        F.min("ingested_at").alias("ingested_at_min"),
        F.max("ingested_at").alias("ingested_at_max"),
        *[
            F.min(c).alias(c)
            for c in (
                "format_hint", "header_count", "delimiter", "encoding", "rows_loaded", "status",
            )
        ],
    )

"""Diagnostics over the marts: why rows are missing, odd or excluded."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions import text
from ratelens.functions.codes import KNOWN_CODE_TYPES, code_type_norm, code_type_or_unknown
from ratelens.functions.codes import issue_of
from ratelens.functions.rates import (
    COMPARABLE_CATEGORIES,
    RATE_CATEGORIES,
    rate_category,
    rate_type_norm,
)


def _counts(df: DataFrame, *keys, name: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def _norm(column: str) -> Column:
    return F.lower(F.trim(F.col(column).cast("string")))


def _union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def looks_like_hash(name) -> Column:
    return F.lower(F.trim(text(name))).rlike("^[0-9a-f]{32}$")


def display_sanity(hospitals: DataFrame, compare: DataFrame, sample: int = 10) -> DataFrame:
    """A sample of hospital names and of the variants of code 99213, each with a verdict."""
    names = (
        hospitals.orderBy("hospital_id", "source_file_name")
        .limit(sample)
        .select(
            F.lit("hospital_name_clean").alias("check_type"),
            F.col("hospital_id").alias("key_value"),
            F.col("hospital_name_clean").alias("detail"),
            (~looks_like_hash("hospital_name_clean")).alias("ok"),
        )
    )
    codes = (
        _counts(compare.filter(F.col("billing_code").contains("99213")), "billing_code")
        .orderBy("billing_code")
        .limit(sample)
        .select(
            F.lit("billing_code_99213").alias("check_type"),
            F.col("billing_code").alias("key_value"),
            F.concat(F.col("row_count").cast("string"), F.lit(" rows")).alias("detail"),
            (F.trim("billing_code") == "99213").alias("ok"),
        )
    )
    return _union(names, codes)


def code_issues(semantic: DataFrame) -> DataFrame:
    """Codes that do not fit their type, with counts."""
    rows = semantic.filter(
        F.col("billing_code").isNotNull() & F.col("billing_code_type").isNotNull()
    ).select(
        F.trim("billing_code").alias("billing_code"),
        code_type_or_unknown("billing_code_type").alias("billing_code_type"),
    )
    # One verdict per distinct code instead of one per rate.
    counted = _counts(rows, "billing_code", "billing_code_type")
    kind = code_type_norm("billing_code_type")
    return (
        counted.withColumn(
            "issue_reason", issue_of(kind, "billing_code")
        )
        .filter("issue_reason is not null")
        .select("billing_code", "billing_code_type", "issue_reason", "row_count")
        .orderBy(F.desc("row_count"), "billing_code_type", "billing_code")
    )


def rule_violations(semantic: DataFrame) -> DataFrame:
    """``code_issues`` under the audit's column names."""
    return code_issues(semantic).withColumnRenamed("issue_reason", "issue_type")


def comparability_funnel(
    semantic: DataFrame, comparable: DataFrame, harmonized: DataFrame
) -> DataFrame:
    """How many rates survive each step, and what the comparable fact is made of.

    Each layer is reduced to counts per category, flag, reason and unit first; everything else is
    arithmetic on those few rows.
    """

    def shape(df: DataFrame) -> DataFrame:
        unit = F.when(F.trim(text("rate_unit")) == "", "blank").otherwise("nonblank")
        return _counts(
            df,
            _norm("rate_category").alias("rate_category"),
            "is_comparable",
            "comparability_reason",
            unit.alias("rate_unit_blank"),
            name="n",
        )

    layers = _union(
        semantic.agg(F.count("*").alias("n")).select(
            F.lit("semantic").alias("layer"),
            F.lit(None).cast("string").alias("rate_category"),
            F.lit(None).cast("boolean").alias("is_comparable"),
            F.lit(None).cast("string").alias("comparability_reason"),
            F.lit(None).cast("string").alias("rate_unit_blank"),
            "n",
        ),
        shape(comparable).withColumn("layer", F.lit("comparable")),
        shape(harmonized).withColumn("layer", F.lit("harmonized")),
    )
    layer, n = F.col("layer"), F.col("n")
    allowed = F.coalesce("is_comparable", F.lit(False))
    is_accepted = F.col("rate_category").isin(*RATE_CATEGORIES)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    steps = {
        "total_semantic_rows": layer == "semantic",
        "accepted_category_rows": (layer == "comparable") & is_accepted,
        "comparable_true_rows": (layer == "harmonized") & allowed,
        "comparable_true_non_other_rows": (layer == "harmonized")
        & allowed
        & (F.col("rate_category") != "other"),
        "comparable_false_rows": (layer == "comparable") & ~allowed,
    }
    funnel = (
        layers.agg(*[total(condition).alias(name) for name, condition in steps.items()])
        .unpivot([], list(steps), "metric_name", "n")
        .select(
            F.lit("funnel").alias("section"),
            "metric_name",
            F.lit(None).cast("string").alias("breakdown_key"),
            "n",
        )
    )
    parts = ("rate_category", "is_comparable", "comparability_reason", "rate_unit_blank")
    breakdown = (
        layers.filter(layer == "comparable")
        .select(*[F.col(p).cast("string").alias(p) for p in parts], "n")
        .unpivot(["n"], list(parts), "metric_name", "breakdown_key")
        .groupBy("metric_name", "breakdown_key")
        .agg(F.sum("n").alias("n"))
        .select(F.lit("breakdown").alias("section"), "metric_name", "breakdown_key", "n")
    )
    return _union(funnel, breakdown).orderBy("section", "metric_name", F.desc("n"))


def procedure_types(procedures: DataFrame) -> DataFrame:
    return _counts(procedures, "billing_code_type").orderBy(F.desc("row_count"))


def unexpected_procedure_types(procedures: DataFrame) -> DataFrame:
    counted = _counts(procedures, "billing_code_type", name="n")
    return counted.filter(~F.col("billing_code_type").isin(*KNOWN_CODE_TYPES)).orderBy(F.desc("n"))


def unexpected_categories(comparable: DataFrame) -> DataFrame:
    counted = _counts(comparable, _norm("rate_category").alias("rate_category_norm"))
    return counted.filter(~F.col("rate_category_norm").isin(*COMPARABLE_CATEGORIES)).orderBy(
        F.desc("row_count")
    )


def hospital_name_issues(hospitals: DataFrame) -> DataFrame:
    """Hospitals whose cleaned name still starts with a digit."""
    return (
        hospitals.filter(F.trim(text("hospital_name_clean")).rlike(r"^\d"))
        .select("hospital_id", "hospital_name", "hospital_name_clean", "source_file_name")
        .orderBy("hospital_name_clean")
    )


def other_rates(harmonized: DataFrame) -> DataFrame:
    norm = _norm("rate_category").alias("rate_category_norm")
    return _counts(
        harmonized.filter(_norm("rate_category") == "other"),
        norm, "is_comparable", "comparability_reason", name="n",
    ).orderBy(F.desc("n"))


def other_leak(comparable: DataFrame, harmonized: DataFrame) -> DataFrame:
    def layer(df: DataFrame, name: str) -> DataFrame:
        return _counts(
            df.filter("rate_category = 'other'"),
            F.lit(name).alias("source"), "rate_category", "is_comparable", "comparability_reason",
            name="n",
        )

    return _union(
        layer(comparable, "fct_rates_comparable"),
        layer(harmonized, "fct_rates_comparable_harmonized"),
    ).orderBy("source", F.desc("n"))


def other_variants(harmonized: DataFrame, compare: DataFrame) -> DataFrame:
    def layer(df: DataFrame, name: str, flag: Column) -> DataFrame:
        return _counts(
            df.filter(_norm("rate_category") == "other"),
            F.lit(name).alias("source"),
            F.col("rate_category").alias("raw_or_category"),
            _norm("rate_category").alias("rate_category_norm"),
            flag.alias("is_comparable"),
            name="n",
        )

    return _union(
        layer(harmonized, "harmonized", F.col("is_comparable")),
        layer(compare, "agg", F.lit(None).cast("boolean")),
    ).orderBy("source", F.desc("n"))


def category_counts(semantic: DataFrame) -> DataFrame:
    return (
        semantic.groupBy(_norm("rate_category").alias("rate_category"), "source_system")
        .agg(F.count("*").alias("rows_"), F.count_distinct("hospital_id").alias("hospitals"))
        .orderBy(F.desc("rows_"))
    )


def unit_profile(semantic: DataFrame, limit: int = 500) -> DataFrame:
    """Category, unit and code type combinations, the most frequent first."""
    keys = {
        "rate_category_norm": _norm("rate_category"),
        "rate_unit_norm": _norm("rate_unit"),
        "billing_code_type_norm": _norm("billing_code_type"),
    }
    return (
        semantic.groupBy(*[column.alias(name) for name, column in keys.items()])
        .agg(
            F.count("*").alias("row_count"),
            F.count("rate_amount").alias("rows_with_numeric_rate"),
            F.count_if(F.trim("rate_unit") != "").alias("rows_with_unit"),
        )
        .orderBy(F.desc("row_count"), *keys)
        .limit(limit)
    )


def rate_type_mapping(base: DataFrame) -> DataFrame:
    """Rate types as files spell them and the category each was given."""
    amounts = ("rate_amount", "gross_charge", "discounted_cash", "minimum", "maximum")
    return _counts(
        base.filter(F.col("billing_code").isNotNull() & (F.col("rate_amount") != 0)),
        "source_system",
        F.col("rate_type").alias("raw_rate_type"),
        rate_type_norm("rate_type").alias("rate_type_norm"),
        rate_category("rate_type", *amounts).alias("derived_rate_category"),
    ).orderBy("source_system", F.desc("row_count"), "raw_rate_type")


def source_field_sample(base: DataFrame, semantic: DataFrame, limit: int = 5000) -> DataFrame:
    """Categorised rates next to the source fields they came from."""
    fields = base.filter(F.col("billing_code").isNotNull()).select(
        "source_system", "source_file_name", "hospital_id", "billing_code", "standard_charge_sk",
        F.col("rate_type").alias("raw_rate_type"),
        rate_type_norm("rate_type").alias("rate_type_norm"),
        F.col("rate_amount").alias("raw_rate_amount"),
        "gross_charge", "discounted_cash", "minimum", "maximum",
    )
    rates = semantic.select(
        "standard_charge_sk",
        F.col("rate_category").alias("current_rate_category"),
        F.col("rate_amount").alias("semantic_rate_amount"),
        "rate_unit",
    )
    return (
        fields.join(rates, "standard_charge_sk")
        .orderBy("source_system", "standard_charge_sk", "current_rate_category")
        .limit(limit)
    )


def type_examples(semantic: DataFrame, per_type: int = 50) -> DataFrame:
    """The most frequent codes of every type."""
    grouped = _counts(
        semantic.filter(F.col("billing_code").isNotNull()),
        code_type_or_unknown("billing_code_type").alias("billing_code_type"),
        F.trim("billing_code").alias("billing_code"),
        F.trim(text("description")).alias("description"),
    )
    order = Window.partitionBy("billing_code_type").orderBy(
        F.desc("row_count"), "billing_code", "description"
    )
    return (
        grouped.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= per_type)
        .drop("_rank")
        .orderBy("billing_code_type", F.desc("row_count"))
    )


def type_filter_path(**layers: DataFrame) -> DataFrame:
    """Rows and distinct codes per type in every layer."""

    def layer(name: str, df: DataFrame) -> DataFrame:
        codes = _counts(
            df.filter(F.col("billing_code").isNotNull()),
            F.lit(name).alias("layer_name"),
            code_type_or_unknown("billing_code_type").alias("billing_code_type"),
            F.trim("billing_code").alias("_code"),
        )
        return codes.groupBy("layer_name", "billing_code_type").agg(
            F.sum("row_count").alias("row_count"), F.count("*").alias("distinct_code_count")
        )

    return _union(*[layer(name, df) for name, df in layers.items()]).orderBy(
        "layer_name", F.desc("row_count")
    )


def type_inventory(semantic: DataFrame) -> DataFrame:
    """Rows, codes and descriptions per type, counted over the distinct combinations."""
    combinations = _counts(
        semantic.filter(F.col("billing_code").isNotNull()),
        code_type_or_unknown("billing_code_type").alias("billing_code_type"),
        F.trim("billing_code").alias("_code"),
        F.trim(text("description")).alias("_described"),
    )
    return (
        combinations.groupBy("billing_code_type")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.count_distinct("_code").alias("distinct_code_count"),
            F.count_distinct("_described").alias("distinct_description_count"),
        )
        .orderBy(F.desc("row_count"))
    )

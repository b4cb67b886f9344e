"""Parameterised analyst queries.

Each takes the marts it reads and returns a lazy frame; a filter that is ``None`` or blank is not
applied.  Top-k reports rank first and look names up afterwards, for the few rows that remain.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions import text
from ratelens.functions.names import payer_plan_label
from ratelens.functions.rates import money_total
from ratelens.operators.diagnostics import looks_like_hash
from ratelens.operators.dims import hospital_display
from ratelens.operators.median import exact_median, join_on
from ratelens.operators.rows import at_least_one, distinct_count, one_row, row_count
from ratelens.plans.marts import Marts
from ratelens.sources.tables import BROADCAST_ROWS, broadcast_if_small, written

ANY = ("", "ANY", "— ANY —")
CODE_KEY = ["billing_code", "billing_code_type"]


def _known_type(column: str = "billing_code_type") -> Column:
    return F.coalesce(column, F.lit("UNKNOWN"))


def _given(value) -> bool:
    return value is not None and str(value).strip() != ""


def _where(df: DataFrame, hospital_ids=None, code_type=None, **equal) -> DataFrame:
    """Rows that equal every given value."""
    for column, value in equal.items():
        if _given(value):
            df = df.filter(F.col(column) == str(value).strip())
    if _given(code_type) and str(code_type).strip().upper() not in ANY:
        df = df.filter(_known_type() == str(code_type).strip())
    if hospital_ids:
        df = df.filter(F.col("hospital_id").isin(list(hospital_ids)))
    return df


def _with_names(df: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Display name of the hospital as ``_clean``."""
    names = hospital_display(hospitals).withColumnRenamed("hospital_name_clean", "_clean")
    return df.join(names, "hospital_id", "left")


def _with_description(df: DataFrame, harmonized: DataFrame) -> DataFrame:
    """Canonical description of the procedure as ``_described``."""
    described = harmonized.select(
        F.col("billing_code").alias("_code"),
        F.col("billing_code_type").alias("_type"),
        F.col("canonical_description").alias("_described"),
    )
    match = (F.col("billing_code") == F.col("_code")) & (_known_type() == F.col("_type"))
    return df.join(described, match, "left").drop("_code", "_type")


def hospitals(marts: Marts) -> DataFrame:
    return marts.dim_hospital.withColumn("hospital_display_name", F.col("hospital_name_clean"))


def payers(marts: Marts) -> DataFrame:
    return marts.dim_payer


def payer_families(marts: Marts) -> DataFrame:
    return marts.dim_payer_harmonized.select("payer_family", "plan_family")


def _compare_rows(df: DataFrame, marts: Marts) -> DataFrame:
    described = _with_description(_with_names(df, marts.dim_hospital),
                                  marts.dim_procedure_harmonized)
    name = F.coalesce("_clean", "hospital_id")
    description = F.coalesce("_described", F.lit(""))
    return described.select(
        "hospital_id",
        name.alias("hospital_name_clean"),
        name.alias("hospital_display_name"),
        "billing_code",
        _known_type().alias("billing_code_type"),
        description.alias("description"),
        "payer_family", "plan_family", "rate_category", "rate_unit", "min_rate", "max_rate",
        "approx_median_rate", "row_count",
        description.alias("canonical_description"),
    )


def hospital_comparison(
    marts: Marts, *, billing_code, payer_family, rate_category, rate_unit, plan_family=None,
    billing_code_type=None, hospital_ids=None,
) -> DataFrame:
    """Like-for-like rates of one procedure and payer across hospitals."""
    rows = marts.agg_hospital_procedure_compare.filter(
        (F.col("billing_code") == billing_code.strip())
        & (F.col("payer_family") == payer_family.strip())
        & (F.col("rate_category") == rate_category.strip())
        & (F.col("rate_unit") == rate_unit.strip())
    )
    rows = _where(rows, hospital_ids, billing_code_type, plan_family=plan_family)
    return _compare_rows(rows, marts).orderBy(F.desc("approx_median_rate"))


def top_codes(
    marts: Marts, billing_code_type=None, hospital_ids=None, limit: int = 100
) -> DataFrame:
    """Codes with the most comparable rates."""
    rows = marts.agg_hospital_procedure_compare
    if _given(billing_code_type):
        rows = rows.filter(_known_type() == str(billing_code_type).strip())
    rows = _where(rows, hospital_ids)
    limit = at_least_one(limit)
    ranked = rows.groupBy(*CODE_KEY).agg(F.sum("row_count").alias("row_count"))
    ranked = ranked.orderBy(F.desc("row_count"), *CODE_KEY).limit(limit)
    ranked = ranked.select(*[F.col(c).alias(f"_{c}") for c in CODE_KEY])
    # Hospitals are told apart for the codes that remain only; both branches read one shuffle of the aggregate.
    top = F.broadcast(ranked) if limit <= BROADCAST_ROWS else ranked
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in CODE_KEY]
    # Per hospital first, so that distinct hospitals are plain counts.
    per_hospital = (
        rows.join(top, same).groupBy(*CODE_KEY, "hospital_id").agg(F.sum("row_count").alias("n"))
    )
    top = per_hospital.groupBy(*CODE_KEY).agg(
        F.sum("n").alias("row_count"), F.count("*").alias("hospitals_covered")
    )
    return (
        _with_description(top, marts.dim_procedure_harmonized)
        .select(
            "billing_code",
            _known_type().alias("billing_code_type"),
            F.coalesce("_described", F.lit("")).alias("canonical_description"),
            "row_count", "hospitals_covered",
        )
        .orderBy(F.desc("row_count"), *CODE_KEY)
    )


def payer_plan_detail(
    marts: Marts, *, billing_code, rate_category, rate_unit, payer_family=None, plan_family=None,
    billing_code_type=None, hospital_ids=None,
) -> DataFrame:
    """Comparable rates of one procedure over payers and plans."""
    rows = marts.agg_payer_plan_compare.filter(
        (F.col("billing_code") == billing_code.strip())
        & (F.col("rate_category") == rate_category.strip())
        & (F.col("rate_unit") == rate_unit.strip())
    )
    rows = _where(
        rows, hospital_ids, billing_code_type, payer_family=payer_family, plan_family=plan_family
    )
    return _compare_rows(rows, marts)


def _rollup(detail: DataFrame, key: str) -> list:
    mean = money_total("approx_median_rate") / F.count("approx_median_rate")
    return [
        F.min("min_rate").alias("min_rate"),
        mean.alias("median_rate"),
        F.max("max_rate").alias("max_rate"),
        F.sum("row_count").alias("row_count"),
    ]


def payer_rollup(detail: DataFrame, rate_category: str, rate_unit: str) -> DataFrame:
    """Detail rows per payer family; the median is the mean of the group medians."""
    return (
        detail.groupBy("payer_family")
        .agg(
            *_rollup(detail, "payer_family"),
            F.count_distinct("hospital_id").alias("hospitals_covered"),
        )
        .withColumns({"rate_category": F.lit(rate_category), "rate_unit": F.lit(rate_unit)})
    )


def plan_rollup(
    detail: DataFrame, payer_family: str, rate_category: str, rate_unit: str
) -> DataFrame:
    """Detail rows of one payer family per plan family."""
    return (
        detail.filter(F.col("payer_family") == payer_family)
        .groupBy("plan_family")
        .agg(*_rollup(detail, "plan_family"))
        .withColumns({"rate_category": F.lit(rate_category), "rate_unit": F.lit(rate_unit)})
    )


def rejects_summary(
    marts: Marts, *, billing_code, rate_category, rate_unit
) -> DataFrame:
    """Why rates of one procedure may not be compared, over all its rejects."""
    rejects = marts.fct_rates_comparable_rejects.filter(
        (F.col("billing_code") == billing_code.strip())
        & (F.col("rate_category") == rate_category.strip())
        & (F.col("rate_unit") == rate_unit.strip())
    )
    return (
        rejects.groupBy("comparability_reason")
        .agg(
            F.count("*").alias("row_count"),
            F.min("payer_name").alias("sample_payer_name"),
            F.min("hospital_id").alias("sample_hospital_id"),
        )
        .orderBy(F.desc("row_count"))
    )


def search_procedures(marts: Marts, query: str | None, limit: int = 50) -> DataFrame:
    """Procedures whose code or description contains the text; ``%`` and ``_`` are wildcards."""
    rows = marts.dim_procedure_harmonized.select(
        *CODE_KEY, F.col("canonical_description").alias("description")
    )
    if _given(query):
        pattern = f"%{query.strip()}%".lower()
        rows = rows.filter(
            F.lower(text("billing_code")).like(pattern)
            | F.lower(text("description")).like(pattern)
        )
    return rows.orderBy(*CODE_KEY).limit(int(limit))


RATE_COLUMNS = (
    "semantic_charge_sk", "hospital_id", "hospital_name_clean", "billing_code",
    "billing_code_type", "description", "payer_family", "plan_family", "rate_category",
    "rate_amount", "rate_unit", "ingested_at",
)


def _named_rates(top: DataFrame, marts: Marts) -> DataFrame:
    named = _with_description(_with_names(top, marts.dim_hospital),
                              marts.dim_procedure_harmonized)
    return (
        named.withColumns(
            {
                "hospital_name_clean": F.coalesce("_clean", "hospital_name"),
                "description": F.coalesce("_described", "description"),
            }
        )
        .select(*RATE_COLUMNS)
        .orderBy(F.desc("rate_amount"), "semantic_charge_sk")
    )


def _top_rates(df: DataFrame, limit: int) -> DataFrame:
    return df.orderBy(F.desc("rate_amount"), "semantic_charge_sk").limit(limit)


def comparable_rates(
    marts: Marts, *, billing_code=None, rate_category=None, rate_unit=None,
    billing_code_type=None, payer_family=None, plan_family=None, hospital_id=None,
    hospital_ids=None, limit: int = 500,
) -> DataFrame:
    """Highest comparable rates of one procedure; empty unless code, category and unit are given."""
    rows = marts.fct_rates_comparable_harmonized
    if not (billing_code and rate_category and rate_unit):
        rows = rows.filter(F.lit(False))
    rows = _where(
        rows, hospital_ids, billing_code_type, billing_code=billing_code,
        rate_category=rate_category, rate_unit=rate_unit, payer_family=payer_family,
        plan_family=plan_family, hospital_id=None if hospital_ids else hospital_id,
    )
    return _named_rates(_top_rates(rows, at_least_one(limit)), marts)


def hospital_rates(
    marts: Marts, *, hospital_id=None, billing_code=None, payer_name=None, plan_name=None,
    rate_category=None, billing_code_type=None, limit: int = 500,
) -> DataFrame:
    """Highest rates of one hospital, comparable or not; empty unless a hospital is given."""
    rows = marts.fct_standard_charges_semantic
    if not _given(hospital_id):
        rows = rows.filter(F.lit(False))
    else:
        rows = rows.filter(F.col("hospital_id") == hospital_id.strip())
    given = {
        "billing_code": billing_code, "payer_name": payer_name, "plan_name": plan_name,
        "rate_category": rate_category,
    }
    for column, value in given.items():
        if value:
            rows = rows.filter(F.col(column) == value)
    if billing_code_type:
        rows = rows.filter(_known_type() == billing_code_type.strip())
    families = marts.dim_payer_harmonized.select(
        F.col("payer_name_raw").alias("_payer_raw"), F.col("plan_name_raw").alias("_plan_raw"),
        "payer_family", "plan_family",
    )
    top = _top_rates(rows, at_least_one(limit)).join(
        families,
        (F.coalesce(F.trim("payer_name"), F.lit("")) == F.col("_payer_raw"))
        & (F.coalesce(F.trim("plan_name"), F.lit("")) == F.col("_plan_raw")),
        "left",
    )
    top = top.withColumns(
        {
            "payer_family": F.coalesce("payer_family", "payer_name"),
            "plan_family": F.coalesce("plan_family", "plan_name"),
        }
    )
    return _named_rates(top, marts)


def get_rates(marts: Marts, use_comparable: bool = True, **filters) -> DataFrame:
    """Highest rates, from the comparable fact or from everything one hospital publishes."""
    return (comparable_rates if use_comparable else hospital_rates)(marts, **filters)


def overview_metrics(marts: Marts) -> DataFrame:
    """Table sizes and the span of load times, as one row."""
    charges = marts.fct_standard_charges_semantic.agg(
        F.count("*").alias("charges_rows"),
        F.min("ingested_at").alias("min_ingested_at"),
        F.max("ingested_at").alias("max_ingested_at"),
    )
    return one_row(
        charges,
        row_count(marts.dim_hospital, "hospitals_rows"),
        row_count(marts.dim_payer, "payers_rows"),
        row_count(marts.dim_procedure, "procedures_rows"),
    )


def code_type_breakdown(marts: Marts, exclude_types=("APC",)) -> DataFrame:
    """Distinct codes per hospital and code type, with the hospital's total."""
    excluded = [t.strip().upper() for t in exclude_types or () if t and t.strip()]
    rows = marts.fct_standard_charges_semantic
    if excluded:
        rows = rows.filter(~F.upper(F.trim(text("billing_code_type"))).isin(*excluded))
    codes = rows.select(
        "hospital_id",
        F.coalesce(F.trim("billing_code_type"), F.lit("UNKNOWN")).alias("billing_code_type"),
        "billing_code",
    ).distinct()
    named = _with_names(codes, marts.dim_hospital)
    counted = named.groupBy(
        F.coalesce("_clean", "hospital_id").alias("hospital_name_clean"), "billing_code_type"
    ).agg(F.count_distinct("billing_code").alias("distinct_codes"))
    total = F.sum("distinct_codes").over(Window.partitionBy("hospital_name_clean"))
    return counted.withColumns(
        {"distinct_billing_code_count": F.col("distinct_codes"), "total_distinct_codes": total}
    ).orderBy(F.desc("total_distinct_codes"), "hospital_name_clean", "billing_code_type")


def category_distribution(marts: Marts) -> DataFrame:
    return (
        marts.fct_standard_charges_semantic.groupBy("rate_category")
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"))
    )


def hospital_kpis(marts: Marts, hospital_id: str) -> DataFrame:
    """Size, variety and spread of one hospital's rates, as one row."""
    rows = marts.fct_standard_charges_semantic.filter(F.col("hospital_id") == hospital_id)
    pair = F.concat_ws("|", text("payer_name"), text("plan_name"))
    return one_row(
        rows.agg(
            F.count("*").alias("total_rows"),
            F.percentile_approx("rate_amount", F.lit(0.5), F.lit(10000)).alias("median_rate"),
            F.min("rate_amount").alias("min_rate"),
            F.max("rate_amount").alias("max_rate"),
        ),
        distinct_count(rows, "billing_code", "distinct_procedures"),
        distinct_count(rows, pair, "distinct_payer_plan"),
    )


def hospital_payer_coverage(marts: Marts, hospital_id: str, limit: int = 100) -> DataFrame:
    return (
        marts.fct_standard_charges_semantic.filter(F.col("hospital_id") == hospital_id)
        .groupBy("payer_name", "plan_name")
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), "payer_name", "plan_name")
        .limit(at_least_one(limit))
    )


def hospital_top_procedures(marts: Marts, hospital_id: str, limit: int = 50) -> DataFrame:
    top = (
        marts.fct_standard_charges_semantic.filter(F.col("hospital_id") == hospital_id)
        .groupBy(*CODE_KEY)
        .agg(F.count("*").alias("row_count"), F.max("description").alias("_own"))
        .orderBy(F.desc("row_count"), *CODE_KEY)
        .limit(at_least_one(limit))
    )
    return (
        _with_description(top, marts.dim_procedure_harmonized)
        .select(*CODE_KEY, F.coalesce("_described", "_own").alias("description"), "row_count")
        .orderBy(F.desc("row_count"), *CODE_KEY)
    )


def coverage_matrix(marts: Marts) -> DataFrame:
    """How many codes, payers and plans every hospital can be compared on."""
    # A task tells each code, payer and plan of a hospital once before they are shuffled.
    per_hospital = marts.agg_payer_plan_compare.groupBy("hospital_id").agg(
        F.count_distinct("billing_code").alias("distinct_billing_codes"),
        F.count_distinct("payer_family").alias("distinct_payer_family"),
        F.count_distinct("plan_family").alias("distinct_plan_family"),
        F.sum("row_count").alias("total_comparable_rows"),
    )
    return (
        _with_names(per_hospital, marts.dim_hospital)
        .withColumn("hospital_name_clean", F.coalesce("_clean", "hospital_id"))
        .drop("_clean")
        .orderBy(F.desc("total_comparable_rows"))
    )


def top_procedure_variants(marts: Marts, limit: int = 50) -> DataFrame:
    return (
        marts.dim_procedure_harmonized.filter("description_variants_count > 0")
        .orderBy(F.desc("description_variants_count"), *CODE_KEY)
        .limit(at_least_one(limit))
    )


def payer_family_variants(marts: Marts, limit: int = 50) -> DataFrame:
    """Families that several spellings map to."""
    return (
        marts.dim_payer_harmonized.groupBy("payer_family")
        .agg(F.count_distinct("payer_name_norm").alias("payer_name_norm_count"))
        .filter("payer_name_norm_count > 1")
        .orderBy(F.desc("payer_name_norm_count"), "payer_family")
        .limit(at_least_one(limit))
    )


MEASURED_NULLS = ("hospital_id", "billing_code", "rate_amount", "description")


def _null_share(column: str) -> Column:
    share = F.lit(100.0) * F.count_if(F.col(column).isNull()) / F.count("*")
    return F.coalesce(share, F.lit(0.0))


def data_quality_metrics(marts: Marts) -> DataFrame:
    return marts.fct_standard_charges_semantic.agg(
        *[F.round(_null_share(c), 2).alias(f"pct_null_{c}") for c in MEASURED_NULLS],
        F.count_if(F.lower(text("billing_code_type")) == "unknown").alias(
            "unknown_billing_code_type_count"
        ),
        F.count("*").alias("total_rows"),
    )


def outlier_rates(marts: Marts, limit: int = 100) -> DataFrame:
    """The highest amounts published anywhere."""
    top = _top_rates(marts.fct_standard_charges_semantic, at_least_one(limit))
    named = _with_description(_with_names(top, marts.dim_hospital),
                              marts.dim_procedure_harmonized)
    return (
        named.select(
            "hospital_id",
            F.coalesce("_clean", "hospital_name").alias("hospital_name"),
            "billing_code",
            F.coalesce("_described", "description").alias("description"),
            "rate_category", "rate_amount", "payer_name", "plan_name", "semantic_charge_sk",
        )
        .orderBy(F.desc("rate_amount"), "semantic_charge_sk")
        .drop("semantic_charge_sk")
    )


def display_diagnostic(marts: Marts) -> DataFrame:
    """One row per display check: is a hospital name readable, is code 99213 stored as such."""
    name = marts.dim_hospital.agg(
        F.min_by("hospital_name_clean", F.struct("hospital_id", "source_file_name")).alias("name")
    )
    hashed = looks_like_hash("name")
    shown = F.concat(
        F.substring("name", 1, 50), F.when(F.length("name") > 50, "...").otherwise("")
    )
    absent = F.col("name").isNull()
    hospitals_row = name.select(
        F.when(absent, "dim_hospital_sample")
        .otherwise("dim_hospital_hospital_name_clean")
        .alias("check_name"),
        F.when(absent, "no rows").when(hashed, "hash-like").otherwise("human-readable")
        .alias("result_summary"),
        shown.alias("sample_value"),
        (~absent & ~hashed).alias("ok"),
    )
    variants = marts.agg_hospital_procedure_compare.filter(
        F.col("billing_code").contains("99213")
    ).agg(
        F.min("billing_code").alias("code"),
        F.coalesce(F.max(F.trim("billing_code") == "99213"), F.lit(False)).alias("exact"),
    )
    missing = F.col("code").isNull()
    codes_row = variants.select(
        F.when(missing, "billing_code_99213")
        .otherwise("billing_code_99213_normalized")
        .alias("check_name"),
        F.when(missing, "no 99213 rows").when(F.col("exact"), "99213 exact")
        .otherwise("99213 has variant (e.g. leading digit)")
        .alias("result_summary"),
        F.col("code").alias("sample_value"),
        F.col("exact").alias("ok"),
    )
    return hospitals_row.unionByName(codes_row)


def data_health(marts: Marts) -> DataFrame:
    """Sizes, load span, variety and unrounded null shares, as one row."""
    charges = marts.fct_standard_charges_semantic
    return one_row(
        charges.agg(
            F.count("*").alias("charges_rows"),
            F.min("ingested_at").alias("min_ingested_at"),
            F.max("ingested_at").alias("max_ingested_at"),
            *[_null_share(c).alias(f"pct_null_{c}") for c in MEASURED_NULLS],
        ),
        row_count(marts.dim_hospital, "hospitals_rows"),
        row_count(marts.dim_procedure, "procedures_rows"),
        row_count(marts.dim_payer, "payers_rows"),
        distinct_count(charges, "hospital_id", "distinct_hospital_id"),
        distinct_count(charges, "billing_code", "distinct_billing_code"),
    )


def hospital_metrics(marts: Marts, hospital_name: str) -> DataFrame:
    """Exact statistics of the hospital with this published name; no row when it has no rates."""
    rows = marts.fct_standard_charges_semantic.filter(F.col("hospital_name") == hospital_name)
    return one_row(
        rows.agg(
            F.count("*").alias("total_rows"),
            F.min("rate_amount").alias("min_rate_amount"),
            F.max("rate_amount").alias("max_rate_amount"),
        ),
        distinct_count(rows, "billing_code", "distinct_billing_code"),
        exact_median(rows, [], "rate_amount", "median_rate_amount"),
    ).filter("total_rows > 0")


def hospital_top_rates(marts: Marts, hospital_name: str, limit: int = 50) -> DataFrame:
    rows = marts.fct_standard_charges_semantic.filter(F.col("hospital_name") == hospital_name)
    order = [F.desc_nulls_last("rate_amount"), F.col("semantic_charge_sk")]
    return rows.orderBy(*order).limit(limit).select(
        "hospital_name", "billing_code", "billing_code_type", "description", "rate_amount",
        "rate_category", "ingested_at",
    )


def denormalized(marts: Marts) -> DataFrame:
    """Every rate with display columns; one description per code and type, so no rate repeats."""
    described = (
        marts.dim_procedure.filter(F.col("description").isNotNull())
        .groupBy(*CODE_KEY)
        .agg(F.min("description").alias("_described"))
    )
    # Both lookups are written first, so that small ones are sent to the rates instead of shuffling every rate.
    described = broadcast_if_small(written(described))
    names = hospital_display(marts.dim_hospital).withColumnRenamed("hospital_name_clean", "_clean")
    names = broadcast_if_small(written(names))
    rows = marts.fct_standard_charges_semantic.join(names, "hospital_id", "left")
    return (
        rows.join(described, CODE_KEY, "left")
        .withColumns(
            {
                "hospital_name_display": F.col("_clean"),
                "procedure_description": F.coalesce("_described", "description"),
                "payer_display": payer_plan_label("payer_name", "plan_name"),
            }
        )
        .drop("_clean", "_described")
    )


def search_rates(
    marts: Marts, hospital_names=None, rate_categories=None, search=None, payer_names=None
) -> DataFrame:
    """Denormalised rates that satisfy every given filter."""
    rows = denormalized(marts)
    listed = {
        "hospital_name_display": hospital_names,
        "rate_category": rate_categories,
        "payer_display": payer_names,
    }
    for column, values in listed.items():
        if values:
            rows = rows.filter(F.col(column).isin(list(values)))
    if _given(search):
        needle = search.strip().lower()
        fields = ("billing_code", "billing_code_type", "procedure_description")
        hits = [F.lower(text(f)).contains(needle) for f in fields]
        rows = rows.filter(reduce(Column.__or__, hits))
    return rows


def search_kpis(rates: DataFrame) -> DataFrame:
    """Size and variety of a search result and its exact median negotiated rate, as one row."""
    negotiated = rates.filter("rate_category = 'negotiated'")
    return one_row(
        row_count(rates, "row_count"),
        distinct_count(rates, "hospital_id", "distinct_hospitals"),
        distinct_count(rates, "billing_code", "distinct_codes"),
        exact_median(negotiated, [], "rate_amount", "median_negotiated"),
    )


def top_procedures_by_median(rates: DataFrame, limit: int = 10) -> DataFrame:
    """Procedures with the highest exact median negotiated dollar rate."""
    dollars = rates.filter("rate_category = 'negotiated' and rate_unit = 'dollars'")
    key = ["billing_code", "procedure_description"]
    label = F.concat(
        text("billing_code"), F.lit(" – "), F.substring(text("procedure_description"), 1, 40)
    )
    return (
        exact_median(dollars, key, "rate_amount", "rate_amount")
        .orderBy(F.desc("rate_amount"), *key)
        .limit(limit)
        .withColumn("procedure_label", label)
    )


def amount_histogram(rates: DataFrame, bins: int = 50) -> DataFrame:
    """Rates per equal-width bin of the dollar amount; the largest amount falls in the last bin."""
    dollars = rates.filter("rate_unit = 'dollars' and rate_amount is not null")
    ends = dollars.agg(F.min("rate_amount").alias("low"), F.max("rate_amount").alias("high")).first()
    low, high = F.lit(ends["low"]), F.lit(ends["high"])
    position = F.when(high == low, 0).otherwise(
        F.floor((F.col("rate_amount") - low) * bins / (high - low))
    )
    return (
        dollars.groupBy((F.least(position, F.lit(bins - 1)) + 1).cast("int").alias("bin"))
        .agg(F.count("*").alias("rate_count"))
        .orderBy("bin")
    )


def measures(marts: Marts) -> DataFrame:
    """The scalar report measures, as one row."""
    rates = marts.fct_standard_charges_semantic
    dollars = F.col("rate_unit") == "dollars"
    amount = F.col("rate_amount")
    totals = rates.agg(
        money_total(F.when(dollars, amount)).alias("total_charge_amount"),
        money_total(F.when(dollars & (F.col("rate_category") == "negotiated"), amount)).alias(
            "_negotiated"
        ),
        money_total(F.when(F.col("rate_category") == "gross", amount)).alias("gross_charge_total"),
        money_total(F.when(F.col("rate_category") == "cash", amount)).alias("cash_price_total"),
        F.count("semantic_charge_sk").alias("distinct_charge_records"),  # the fact's unique key
    )
    row = one_row(
        totals,
        distinct_count(rates, "billing_code", "procedure_count"),
        distinct_count(rates, "hospital_id", "hospital_count"),
    )
    return row.select(
        "total_charge_amount",
        "distinct_charge_records",
        F.try_divide("total_charge_amount", "procedure_count").alias("average_charge_per_procedure"),
        F.try_divide("_negotiated", "total_charge_amount").alias("negotiated_share"),
        "gross_charge_total", "cash_price_total", "procedure_count", "hospital_count",
    )


def charge_spread(marts: Marts) -> DataFrame:
    """Listed maximum minus listed minimum per procedure, hospital and payer."""
    amount = F.col("rate_amount")
    high = F.max(F.when(F.col("rate_category") == "max", amount))
    low = F.min(F.when(F.col("rate_category") == "min", amount))
    return (
        marts.fct_standard_charges_semantic.filter(F.col("rate_category").isin("min", "max"))
        .groupBy("hospital_id", "billing_code", "payer_name")
        .agg((high - low).alias("charge_spread"))
    )


def payer_totals(marts: Marts) -> DataFrame:
    """Dollars listed per payer and plan."""
    return (
        marts.fct_standard_charges_semantic.filter("rate_unit = 'dollars'")
        .groupBy("payer_name", "plan_name")
        .agg(money_total("rate_amount").alias("payer_charge_total"))
    )


def median_negotiated(marts: Marts) -> DataFrame:
    """Exact median negotiated rate per hospital, procedure and payer."""
    rows = marts.fct_standard_charges_semantic.filter("rate_category = 'negotiated'")
    return exact_median(
        rows, ["hospital_id", "billing_code", "payer_name"], "rate_amount",
        "median_negotiated_rate",
    )


def average_cash(marts: Marts) -> DataFrame:
    """Average cash price per hospital and procedure."""
    return (
        marts.fct_standard_charges_semantic.filter("rate_category = 'cash'")
        .groupBy("hospital_id", "billing_code")
        .agg((money_total("rate_amount") / F.count("rate_amount")).alias("average_cash_price"))
    )


def negotiated_cash_delta(marts: Marts) -> DataFrame:
    """Median negotiated rate minus average cash price, where a hospital lists both."""
    key = ["hospital_id", "billing_code"]
    rows = marts.fct_standard_charges_semantic.filter("rate_category = 'negotiated'")
    medians = exact_median(rows, key, "rate_amount", "median_negotiated_rate")
    both = join_on(medians, average_cash(marts), key, "inner")
    return both.withColumn(
        "negotiated_cash_delta",
        F.col("median_negotiated_rate") - F.col("average_cash_price"),
    )


def hospital_options(marts: Marts, search: str | None = None) -> DataFrame:
    """Published hospital names, optionally those containing a text."""
    names = marts.fct_standard_charges_semantic.select("hospital_name").filter(
        F.col("hospital_name").isNotNull()
    )
    if _given(search):
        names = names.filter(F.lower("hospital_name").contains(search.strip().lower()))
    return names.distinct().orderBy("hospital_name")


def payer_family_options(marts: Marts) -> DataFrame:
    return marts.dim_payer_harmonized.select("payer_family").distinct().orderBy("payer_family")


def plan_family_options(marts: Marts, payer_family: str) -> DataFrame:
    return (
        marts.dim_payer_harmonized.filter(F.col("payer_family") == payer_family)
        .select("plan_family")
        .distinct()
        .orderBy("plan_family")
    )

"""Registered queries: one per operator, each over whole tables."""

import hashlib

from pyspark.sql import functions as F

from ratelens.functions import codes, rates
from ratelens.functions.codes import KNOWN_CODE_TYPES
from ratelens.functions.keys import name_key
from ratelens.functions.names import (
    clean_hospital_name,
    file_display_name,
    hospital_match_name,
    match_text,
    safe_preview,
)
from ratelens.functions.rates import RATE_CATEGORIES, parse_rate, strict_amount
from ratelens.operators import (
    aggs,
    analyst,
    diagnostics,
    dims,
    facts,
    quality,
    silver,
    staging,
)
from ratelens.plans import testdata
from ratelens.plans.marts import from_test_tables
from ratelens.schemas import SOURCE_SYSTEMS
from ratelens.session import configure
from ratelens.sources import csv_files, files, json_elements, json_files
from ratelens.sources.tables import broadcast_if_small, written

QUERIES = {}


def query(name):
    """Register a function of (marts, spark, sf_dir)."""

    def register(build):
        def run(spark, sf_dir):
            configure(spark)
            return build(from_test_tables(spark, sf_dir), spark, sf_dir)

        QUERIES[name] = run
        return build

    return register


def mart(name, build):
    query(name)(lambda m, spark, sf_dir: build(m))


def source(spark, sf_dir, name):
    return testdata.source(spark, sf_dir, name)


# Marts.
mart("m01_dim_hospital", lambda m: m.dim_hospital)
mart("m03_dim_payer", lambda m: m.dim_payer)
mart("m04_dim_payer_harmonized", lambda m: m.dim_payer_harmonized)
mart("m05_dim_procedure", lambda m: m.dim_procedure)
mart("m06_dim_procedure_harmonized", lambda m: m.dim_procedure_harmonized)
mart("m07_dim_source_file", lambda m: m.dim_source_file)
mart("m08_standard_charges", lambda m: m.fct_standard_charges)
mart("m13_semantic", lambda m: m.fct_standard_charges_semantic)
mart("m15_comparable", lambda m: m.fct_rates_comparable)
mart("m16_harmonized", lambda m: m.fct_rates_comparable_harmonized)
mart("m17_rejects", lambda m: m.fct_rates_comparable_rejects)
mart("m18_code_rejects", lambda m: m.fct_billing_code_rejects)
mart("m19_agg_compare", lambda m: m.agg_hospital_procedure_compare)
mart(
    "m19_agg_compare_exact",
    lambda m: aggs.hospital_procedure_compare(m.fct_rates_comparable_harmonized, exact=True),
)
mart("m20_payer_plan_compare", lambda m: m.agg_payer_plan_compare)
mart(
    "m16_harmonized_by_dimension",
    lambda m: facts.harmonized_by_dimension(
        m.fct_rates_comparable, broadcast_if_small(written(m.dim_payer_harmonized))
    ),
)


@query("m02_lake_dim_hospital")
def _(m, spark, sf_dir):
    return dims.lake_dim_hospital(lake_base(spark, sf_dir))


@query("m09_incremental_merge")
def _(m, spark, sf_dir):
    """Charges up to the end of 1996 as the target, then the whole base merged into it."""
    loaded = m.fct_standard_charges.filter(F.col("ingested_at") < F.lit("1997-01-01"))
    return facts.merge_charges(loaded, m.base, m.hospital_ids)


@query("m10_lake_standard_charges")
def _(m, spark, sf_dir):
    base = written(lake_base(spark, sf_dir))
    return facts.lake_standard_charges(base, dims.lake_dim_hospital(base))


@query("m14_lake_semantic")
def _(m, spark, sf_dir):
    base = written(lake_base(spark, sf_dir))
    return facts.lake_semantic_charges(
        facts.lake_standard_charges(base, dims.lake_dim_hospital(base))
    )


def candidates(spark, sf_dir):
    return silver.candidate_rates(testdata.bronze_all(spark, sf_dir))


def lake_base(spark, sf_dir):
    return staging.lake_base(silver.good_rates(candidates(spark, sf_dir)))


# Staging.
@query("t01_stage_json")
def _(m, spark, sf_dir):
    return oracle_amounts(staging.stage_json_rates(source(spark, sf_dir, "landing_json")))


@query("t02_stage_csv_tall")
def _(m, spark, sf_dir):
    return oracle_amounts(
        staging.stage_csv_tall(source(spark, sf_dir, "landing_tall"), m.csv_registry)
    )


@query("t03_stage_csv_wide")
def _(m, spark, sf_dir):
    return oracle_amounts(
        staging.stage_csv_wide(source(spark, sf_dir, "landing_wide"), m.csv_registry)
    )


def oracle_amounts(df):
    """Decimal amounts as doubles, the form results are compared in."""
    decimals = [f.name for f in df.schema if f.dataType.simpleString().startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


def staged_union(m, spark, sf_dir):
    return staging.written_charge_base(
        staging.stage_json_rates(source(spark, sf_dir, "landing_json")),
        staging.stage_csv_tall(source(spark, sf_dir, "landing_tall"), m.csv_registry),
        staging.stage_csv_wide(source(spark, sf_dir, "landing_wide"), m.csv_registry),
    )


@query("t04_registry_names")
def _(m, spark, sf_dir):
    return staging.registry_names(m.csv_registry)


@query("t05_file_display_name")
def _(m, spark, sf_dir):
    files = m.csv_registry.select("source_file_name").distinct()
    return files.withColumn("display_name", file_display_name("source_file_name"))


mart("t06_file_names", lambda m: dims.file_names(m.csv_registry, m.json_registry))


@query("t07_hospital_id")
def _(m, spark, sf_dir):
    suppliers = testdata.table(spark, sf_dir, "supplier")
    return suppliers.select("s_name", name_key("s_name").alias("hospital_id"))


@query("t08_lake_base")
def _(m, spark, sf_dir):
    return lake_base(spark, sf_dir)


@query("t09_union_base")
def _(m, spark, sf_dir):
    return oracle_amounts(staged_union(m, spark, sf_dir))


@query("t10_charge_key")
def _(m, spark, sf_dir):
    keyed = staging.with_charge_key(source(spark, sf_dir, "charges"))
    return keyed.select("standard_charge_sk", "source_file_name", "run_id", "raw_rate_json")


@query("t11_payload_fingerprint")
def _(m, spark, sf_dir):
    rows = source(spark, sf_dir, "landing_tall")
    return rows.groupBy(F.sha2("raw", 256).alias("fingerprint")).agg(
        F.count("*").alias("row_count")
    )


@query("t12_dedupe")
def _(m, spark, sf_dir):
    """Every charge delivered twice, the second time by another run."""
    once = source(spark, sf_dir, "charges")
    again = once.withColumn("run_id", F.concat(F.lit("retry-"), "run_id"))
    return staging.redelivered_base(once, again)


# Lake rates.
@query("v01_parse_rate")
def _(m, spark, sf_dir):
    rows = source(spark, sf_dir, "lake_tabular")
    return rows.groupBy(
        F.col("negotiated_rate").alias("cell"), parse_rate("negotiated_rate").alias("amount")
    ).agg(F.count("*").alias("row_count"))


@query("v02_strict_amount")
def _(m, spark, sf_dir):
    rows = source(spark, sf_dir, "lake_tabular")
    return rows.groupBy(
        F.col("negotiated_rate").alias("cell"), strict_amount("negotiated_rate").alias("amount")
    ).agg(F.count("*").alias("row_count"))


@query("v05_payload_rates")
def _(m, spark, sf_dir):
    return silver.candidate_rates(testdata.bronze(spark, sf_dir, "lake_payload")).drop("branch")


@query("v08_tabular_rates")
def _(m, spark, sf_dir):
    return silver.candidate_rates(testdata.bronze(spark, sf_dir, "lake_tabular"))


@query("v10_reason_counts")
def _(m, spark, sf_dir):
    return (
        candidates(spark, sf_dir)
        .groupBy("branch", "rate_type", "reason_code")
        .agg(F.count("*").alias("row_count"))
    )


@query("v12_quarantine")
def _(m, spark, sf_dir):
    return silver.quarantined(candidates(spark, sf_dir))


@query("v12_good")
def _(m, spark, sf_dir):
    return silver.good_rates(candidates(spark, sf_dir))


@query("v13_quality_metrics")
def _(m, spark, sf_dir):
    return silver.quality_metrics(candidates(spark, sf_dir))


@query("v14_rows_by_source")
def _(m, spark, sf_dir):
    return silver.rows_by_source(testdata.bronze_all(spark, sf_dir))


@query("v14_good_rows_by_branch")
def _(m, spark, sf_dir):
    return silver.good_rows_by_branch(candidates(spark, sf_dir))


@query("v14_quarantine_reasons")
def _(m, spark, sf_dir):
    return silver.quarantine_reasons(candidates(spark, sf_dir))


@query("v14_candidate_nulls")
def _(m, spark, sf_dir):
    return silver.candidate_nulls(candidates(spark, sf_dir))


@query("v14_rate_types")
def _(m, spark, sf_dir):
    return silver.rate_type_counts(candidates(spark, sf_dir))


@query("v15_gate")
def _(m, spark, sf_dir):
    return silver.gate(silver.quality_metrics(candidates(spark, sf_dir)), 0.3)


# Diagnostics.
mart("g01_display_sanity",
     lambda m: diagnostics.display_sanity(m.dim_hospital, m.agg_hospital_procedure_compare))
mart("g02_code_issues", lambda m: diagnostics.code_issues(m.fct_standard_charges_semantic))
mart("g03_funnel", lambda m: diagnostics.comparability_funnel(
    m.fct_standard_charges_semantic, m.fct_rates_comparable, m.fct_rates_comparable_harmonized))
mart("g04_procedure_types", lambda m: diagnostics.procedure_types(m.dim_procedure))
mart("g05_unexpected_types", lambda m: diagnostics.unexpected_procedure_types(m.dim_procedure))
mart("g06_unexpected_categories", lambda m: diagnostics.unexpected_categories(m.fct_rates_comparable))
mart("g07_hospital_name_issues", lambda m: diagnostics.hospital_name_issues(m.dim_hospital))
mart("g08_other_rates", lambda m: diagnostics.other_rates(m.fct_rates_comparable_harmonized))
mart("g09_other_leak", lambda m: diagnostics.other_leak(
    m.fct_rates_comparable, m.fct_rates_comparable_harmonized))
mart("g10_other_variants", lambda m: diagnostics.other_variants(
    m.fct_rates_comparable_harmonized, m.agg_hospital_procedure_compare))
mart("g11_category_counts", lambda m: diagnostics.category_counts(m.fct_standard_charges_semantic))
mart("g12_unit_profile", lambda m: diagnostics.unit_profile(m.fct_standard_charges_semantic))
mart("g13_rate_type_mapping", lambda m: diagnostics.rate_type_mapping(m.base))
mart("g14_source_fields", lambda m: diagnostics.source_field_sample(
    m.base, m.fct_standard_charges_semantic))
mart("g15_type_examples", lambda m: diagnostics.type_examples(m.fct_standard_charges_semantic))
mart("g16_type_filter_path", lambda m: diagnostics.type_filter_path(
    fct_standard_charges_semantic=m.fct_standard_charges_semantic,
    fct_rates_comparable=m.fct_rates_comparable,
    fct_rates_comparable_harmonized=m.fct_rates_comparable_harmonized,
    agg_hospital_procedure_compare=m.agg_hospital_procedure_compare))
mart("g17_type_inventory", lambda m: diagnostics.type_inventory(m.fct_standard_charges_semantic))
mart("g18_rule_violations", lambda m: diagnostics.rule_violations(m.fct_standard_charges_semantic))

# Analyst queries, with the parameters the oracle uses.
CODE = "00010"
FILTERS = {"billing_code": CODE, "rate_category": "negotiated", "rate_unit": "dollars"}
HOSPITAL = hashlib.md5(b"supplier 000000003").hexdigest()
HOSPITAL_NAME = "Supplier#000000003"

mart("a01_hospitals", analyst.hospitals)
mart("a01_payers", analyst.payers)
mart("a01_payer_families", analyst.payer_families)
mart("a02_hospital_comparison",
     lambda m: analyst.hospital_comparison(m, payer_family="Aetna", **FILTERS))
mart("a02_hospital_comparison_gross", lambda m: analyst.hospital_comparison(
    m, billing_code="0014", payer_family="Aetna", rate_category="gross", rate_unit="dollars",
    plan_family="PPO", billing_code_type="RC"))
mart("a03_top_codes", lambda m: analyst.top_codes(m))
mart("a03_top_codes_by_type",
     lambda m: analyst.top_codes(m, "HCPCS", [HOSPITAL], limit=20))
mart("a04_payer_plan_detail", lambda m: analyst.payer_plan_detail(m, **FILTERS))


def _detail(m):
    return analyst.payer_plan_detail(
        m, billing_code=CODE, rate_category="max", rate_unit="dollars"
    )


mart("a05_payer_rollup", lambda m: analyst.payer_rollup(_detail(m), "max", "dollars"))
mart("a06_plan_rollup", lambda m: analyst.plan_rollup(_detail(m), "Aetna", "max", "dollars"))
mart("a07_rejects_summary", lambda m: analyst.rejects_summary(
    m, billing_code=CODE, rate_category="other", rate_unit="dollars"))
mart("a08_search_procedures", lambda m: analyst.search_procedures(m, "Gear"))
mart("a09_comparable_rates", lambda m: analyst.get_rates(m, **FILTERS))
mart("a10_hospital_rates",
     lambda m: analyst.get_rates(m, use_comparable=False, hospital_id=HOSPITAL, limit=300))
mart("a11_overview", analyst.overview_metrics)
mart("a12_code_type_breakdown", analyst.code_type_breakdown)
mart("a13_category_distribution", analyst.category_distribution)
mart("a14_hospital_kpis", lambda m: analyst.hospital_kpis(m, HOSPITAL))
mart("a15_payer_coverage", lambda m: analyst.hospital_payer_coverage(m, HOSPITAL))
mart("a16_top_procedures", lambda m: analyst.hospital_top_procedures(m, HOSPITAL))
mart("a17_coverage_matrix", analyst.coverage_matrix)
mart("a18_procedure_variants", analyst.top_procedure_variants)
mart("a19_payer_family_variants", analyst.payer_family_variants)
mart("a20_data_quality", analyst.data_quality_metrics)
mart("a21_outliers", analyst.outlier_rates)
mart("a22_display_diagnostic", analyst.display_diagnostic)
mart("a23_data_health", analyst.data_health)
mart("a24_hospital_metrics", lambda m: analyst.hospital_metrics(m, HOSPITAL_NAME))
mart("a25_hospital_top_rates", lambda m: analyst.hospital_top_rates(m, HOSPITAL_NAME))
mart("a26_denormalized", analyst.denormalized)


def _searched(m):
    return analyst.search_rates(
        m, rate_categories=["negotiated", "gross", "cash"], search="gear",
        payer_names=["Aetna [123] | PPO", "CIGNA | PPO", "medicare  | PPO", "AUTOMOBILE"],
    )


mart("a27_search_rates", _searched)
mart("a28_search_kpis", lambda m: analyst.search_kpis(_searched(m)))
mart("a29_top_by_median", lambda m: analyst.top_procedures_by_median(analyst.denormalized(m)))
mart("a30_histogram", lambda m: analyst.amount_histogram(m.fct_standard_charges_semantic))
mart("a31_measures", analyst.measures)
mart("a31_charge_spread", analyst.charge_spread)
mart("a31_payer_totals", analyst.payer_totals)
mart("a32_median_negotiated", analyst.median_negotiated)
mart("a32_average_cash", analyst.average_cash)
mart("a32_negotiated_cash_delta", analyst.negotiated_cash_delta)
mart("a33_hospital_options", lambda m: analyst.hospital_options(m, "0000003"))
mart("a33_payer_family_options", analyst.payer_family_options)
mart("a33_plan_family_options", lambda m: analyst.plan_family_options(m, "Aetna"))

# Functions, over the distinct codes, names and rate types of the charges.
def _with_columns(name, columns, result):
    @query(name)
    def _(m, spark, sf_dir):
        charges = source(spark, sf_dir, "charges")
        return charges.groupBy(*columns, result().alias("result")).agg(
            F.count("*").alias("row_count")
        )


CODE_COLUMNS = ["billing_code", "billing_code_type"]
_with_columns("f01_classify", CODE_COLUMNS, lambda: codes.classify_code("billing_code"))
_with_columns("f02_infer", CODE_COLUMNS, lambda: codes.infer_code_type(*CODE_COLUMNS))
_with_columns("f03_type_norm", CODE_COLUMNS, lambda: codes.code_type_norm("billing_code_type"))
_with_columns("f04_storage", CODE_COLUMNS, lambda: codes.storage_code(*CODE_COLUMNS))
_with_columns("f05_issue", CODE_COLUMNS, lambda: codes.code_issue(*CODE_COLUMNS))
_with_columns("f06_is_valid", CODE_COLUMNS, lambda: codes.code_is_valid(*CODE_COLUMNS))
_with_columns("f07_validation", CODE_COLUMNS, lambda: codes.validation_code(*CODE_COLUMNS))
_with_columns("f08_match_text", ["payer_name"], lambda: match_text("payer_name"))
_with_columns("f12_regexp", ["source_file_name"], lambda: F.concat_ws(
    "|", F.regexp_extract("source_file_name", r"(\d+)_", 1),
    F.col("source_file_name").rlike(r"\.csv$").cast("string"),
    F.regexp_replace("source_file_name", r"\d+", "#")))
_with_columns("f13_strings", ["description"], lambda: F.concat_ws(
    "|", F.trim("description"), F.lower("description"), F.upper("description"),
    F.initcap(F.lower(F.trim("description"))), F.substring(F.trim("description"), 1, 3),
    F.length("description").cast("string"), F.replace("description", F.lit(" "), F.lit("_"))))
_with_columns("f14_hashes", ["source_file_name"], lambda: F.concat_ws(
    "|", F.md5("source_file_name"), F.sha2("source_file_name", 256)))
_with_columns("f18_rate_unit", ["rate_type"], lambda: rates.rate_unit("rate_type"))


@query("f09_numeric")
def _(m, spark, sf_dir):
    rows = source(spark, sf_dir, "lake_tabular")
    cell = F.col("negotiated_rate")
    return rows.groupBy(cell.alias("cell"), rates.numeric(F.trim(cell)).cast("double").alias("result")).agg(
        F.count("*").alias("row_count")
    )


@query("f10_json_value")
def _(m, spark, sf_dir):
    events = testdata.table(spark, sf_dir, "events")
    return events.groupBy(F.get_json_object("props", "$.k").alias("k")).agg(
        F.count("*").alias("row_count")
    )


@query("f11_json_keys")
def _(m, spark, sf_dir):
    rows = source(spark, sf_dir, "landing_tall")
    keys = F.array_join(F.array_sort(F.json_object_keys("raw")), ",")
    return rows.groupBy(keys.alias("json_keys")).agg(F.count("*").alias("row_count"))


@query("f15_round")
def _(m, spark, sf_dir):
    rows = source(spark, sf_dir, "charges")
    share = F.lit(100.0) * F.count_if(F.col("payer_name").isNull()) / F.count("*")
    return rows.groupBy("source_system").agg(F.round(share, 2).alias("pct_null_payer"))


@query("f16_days")
def _(m, spark, sf_dir):
    rows = source(spark, sf_dir, "charges")
    late = F.col("ingested_at") > F.lit("1996-06-30")
    return rows.filter(late).groupBy(F.to_date("ingested_at").alias("day")).agg(
        F.count("*").alias("row_count")
    )


AMOUNTS = ("rate_amount", "gross_charge", "discounted_cash", "minimum", "maximum")
_with_columns("f17_rate_category", ["rate_type"],
              lambda: rates.rate_category("rate_type", *AMOUNTS))


@query("f17_lake_rate_category")
def _(m, spark, sf_dir):
    rows = candidates(spark, sf_dir)
    return rows.groupBy("rate_type", rates.lake_rate_category("rate_type").alias("result")).agg(
        F.count("*").alias("row_count")
    )


@query("f19_comparability")
def _(m, spark, sf_dir):
    rows = m.fct_standard_charges_semantic
    return rows.groupBy(
        rates.comparability_key("billing_code_type", "rate_category", "rate_unit").alias("key"),
        rates.comparability_reason("rate_category").alias("reason"),
    ).agg(F.count("*").alias("row_count"))


@query("f20_hospital_names")
def _(m, spark, sf_dir):
    named = dims.file_names(m.csv_registry, m.json_registry)
    clean = clean_hospital_name("hospital_name_clean")
    return named.select(
        "source_file_name", clean.alias("clean"), hospital_match_name(clean).alias("norm")
    )


# Quality checks.
mart("q01_not_null_semantic", lambda m: quality.not_null(
    m.fct_standard_charges_semantic, "semantic_charge_sk", "hospital_id", "billing_code",
    "rate_category", "ingested_at", "payer_name", "plan_name", "description"))
mart("q01_not_null_compare", lambda m: quality.not_null(
    m.agg_hospital_procedure_compare, "billing_code", "hospital_id", "rate_category",
    "approx_median_rate", "payer_family", "plan_family"))
mart("q02_unique_semantic",
     lambda m: quality.unique(m.fct_standard_charges_semantic, "semantic_charge_sk"))
mart("q02_unique_hospital_id", lambda m: quality.unique(m.dim_hospital, "hospital_id"))
mart("q03_accepted_types",
     lambda m: quality.accepted_values(m.dim_procedure, "billing_code_type", KNOWN_CODE_TYPES))
mart("q03_accepted_categories", lambda m: quality.accepted_values(
    m.fct_rates_comparable, "rate_category", RATE_CATEGORIES))
mart("q03_accepted_systems", lambda m: quality.accepted_values(
    m.fct_standard_charges, "source_system", SOURCE_SYSTEMS))
mart("q04_hospital_relationship", lambda m: quality.relationships(
    m.fct_standard_charges_semantic, "hospital_id", m.dim_hospital, "hospital_id"))
mart("q04_procedure_relationship", lambda m: quality.relationships(
    m.fct_rates_comparable, "billing_code", m.dim_procedure, "billing_code"))
mart("q05_not_empty", lambda m: quality.not_empty(
    m.agg_hospital_procedure_compare, "agg_hospital_procedure_compare"))
mart("q06_code_formats", lambda m: quality.code_formats(m.dim_procedure))
mart("q07_unknown_share", lambda m: quality.unknown_share(m.dim_procedure, 0.01))
mart("q08_numeric_prefixes", lambda m: quality.numeric_prefixes(m.dim_hospital))
mart("q09_invalid_codes", lambda m: quality.invalid_codes(
    agg_hospital_procedure_compare=m.agg_hospital_procedure_compare,
    agg_payer_plan_compare=m.agg_payer_plan_compare))
mart("q10_other_category", lambda m: quality.other_category(m.agg_hospital_procedure_compare))
mart("q15_published_counts", lambda m: quality.published_counts(
    fct_standard_charges_semantic=m.fct_standard_charges_semantic, dim_hospital=m.dim_hospital,
    dim_payer=m.dim_payer, dim_procedure=m.dim_procedure))


@query("q11_landing_counts")
def _(m, spark, sf_dir):
    return quality.landing_counts(source(spark, sf_dir, "landing_tall"), "pt_csv_raw_tall")


@query("q11_extracted_counts")
def _(m, spark, sf_dir):
    extracted = source(spark, sf_dir, "landing_json")
    return quality.landing_counts(extracted, "pt_json_extracted_rates", "record_path")


@query("q12_sample_keys")
def _(m, spark, sf_dir):
    return quality.sample_keys(source(spark, sf_dir, "landing_tall"))


@query("q13_first_rows")
def _(m, spark, sf_dir):
    return quality.first_rows(source(spark, sf_dir, "landing_wide"))


@query("q13_sample_rows")
def _(m, spark, sf_dir):
    extracted = source(spark, sf_dir, "landing_json")
    return quality.sample_rows(extracted, "source_file_name", "ingested_at", "raw_rate", "billing_code")


@query("q14_format_counts")
def _(m, spark, sf_dir):
    landing = source(spark, sf_dir, "landing_tall").unionByName(
        source(spark, sf_dir, "landing_wide")
    )
    return quality.format_counts(landing)


@query("q14_json_rows")
def _(m, spark, sf_dir):
    return quality.json_rows(source(spark, sf_dir, "landing_tall"))


mart("q16_comparable_groups", lambda m: quality.mixed_attributes(
    m.fct_rates_comparable, ["hospital_id", "billing_code"], ["rate_category", "rate_unit"]))


# Ingest operators over the text tables.
def _documents_as_files(spark, sf_dir):
    """Documents in the role of files: a name, a format and the hash of the content."""
    return testdata.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("source_file_name"),
        F.when(F.col("doc_id") % 2 == 0, "csv").otherwise("json").alias("source_format"),
        F.sha2("text", 256).alias("file_hash"),
        "doc_id",
    )


def _loaded_before(spark, sf_dir):
    """A manifest in which every third document succeeded and every third failed."""
    status = F.when(F.col("doc_id") % 3 == 0, "SUCCESS").otherwise("FAILED")
    return (
        _documents_as_files(spark, sf_dir)
        .filter("doc_id % 3 < 2")
        .select("source_file_name", "file_hash", status.alias("status"))
    )


@query("i01_file_hash")
def _(m, spark, sf_dir):
    return _documents_as_files(spark, sf_dir).select("source_file_name", "file_hash")


@query("i02_not_loaded")
def _(m, spark, sf_dir):
    return files.not_loaded(
        _documents_as_files(spark, sf_dir), _loaded_before(spark, sf_dir)
    ).select("source_file_name", "file_hash")


@query("i03_forced")
def _(m, spark, sf_dir):
    return files.not_loaded(
        _documents_as_files(spark, sf_dir), _loaded_before(spark, sf_dir), forced=["pt_csv"]
    ).select("source_file_name", "file_hash")


@query("i12_charge_rows")
def _(m, spark, sf_dir):
    return csv_files.charge_rows(source(spark, sf_dir, "lake_tabular"))


@query("i18_safe_preview")
def _(m, spark, sf_dir):
    documents = testdata.table(spark, sf_dir, "documents")
    return documents.select("doc_id", safe_preview("text").alias("preview"))


RECORD = """concat('{"', case event_id % 3 when 0 then 'code' when 1 then 'billing_code'
 else 'service_code' end, '":"', event_type, '","', case event_id % 2 when 0 then 'price'
 else 'rate' end, '":"', cast(user_id as string), '","name":" ', event_type, ' ","unit":"",',
 '"k":', regexp_extract(props, '([0-9]+)', 1), '}')"""


@query("i19_extract_records")
def _(m, spark, sf_dir):
    events = testdata.table(spark, sf_dir, "events")
    records = events.select(
        F.concat(F.lit("events_"), F.col("event_type"), F.lit(".json")).alias("source_file_name"),
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").alias("ingested_at"),
        F.parse_json(F.expr(RECORD)).alias("record"),
    )
    rates_ = json_files.extract_records(records, json_files.LINE_PATH)
    return oracle_amounts(rates_.drop("raw_rate"))


@query("i23_key_profile")
def _(m, spark, sf_dir):
    lines = testdata.table(spark, sf_dir, "events").select("event_id", F.col("props").alias("line"))
    return json_files.key_profile(lines)


@query("i24_not_registered")
def _(m, spark, sf_dir):
    known = m.csv_registry.select("source_file_name", "status").unionByName(
        m.json_registry.select("source_file_name", "status")
    )
    listed = source(spark, sf_dir, "charges").select("source_file_name").distinct()
    return files.not_registered(listed, known)


@query("i25_load_counts")
def _(m, spark, sf_dir):
    registered = m.csv_registry.unionByName(m.json_registry, allowMissingColumns=True)
    return files.load_counts(registered, source(spark, sf_dir, "landing_tall"))


@query("s07_lenient_objects")
def _(m, spark, sf_dir):
    """JSON lines among all lines of the documents and the event properties."""
    documents = testdata.table(spark, sf_dir, "documents")
    prose = documents.select(F.explode(F.split("text", "\n")).alias("line"))
    props = testdata.table(spark, sf_dir, "events").select(F.col("props").alias("line"))
    found = json_files.lenient_objects(prose.unionByName(props))
    return found.groupBy("line").agg(F.count("*").alias("row_count"))


@query("s01_csv_rows")
def _(m, spark, sf_dir):
    """Canonical rows of CSV files with line breaks in quotes and stray quotes."""
    raw = testdata.csv_lines(spark, sf_dir)
    return csv_files.canonical_rows(raw, written(csv_files.bronze_profile(raw)))


@query("s02_preamble_rows")
def _(m, spark, sf_dir):
    """Landing rows of the same files, below a preamble."""
    raw = testdata.csv_lines(spark, sf_dir)
    return csv_files.landing_rows(raw, written(csv_files.landing_profile(raw)))


@query("i09_header")
def _(m, spark, sf_dir):
    report = csv_files.header_report(testdata.csv_lines(spark, sf_dir))
    return report.withColumn("columns", F.array_join("columns", "|"))


@query("i13_delimiter")
def _(m, spark, sf_dir):
    profile = csv_files.landing_profile(testdata.csv_lines(spark, sf_dir))
    return profile.select(
        "source_path", "encoding", "delimiter", "format_hint", F.col("header_count").cast("long").alias("header_count"),
        F.to_json("preamble_kv").alias("preamble"),
    )


@query("s03_documents")
def _(m, spark, sf_dir):
    """Elements of the array in JSON documents that were split at braces, blocks and all."""
    cut = json_elements.elements(testdata.json_chunks(spark, sf_dir), "standard_charge_information")
    return cut.select("source_path", "element")


@query("i20_services")
def _(m, spark, sf_dir):
    """Rates extracted from the services of the same documents."""
    cut = json_elements.elements(testdata.json_chunks(spark, sf_dir), "standard_charge_information")
    services = cut.select(
        files.base_name("source_path").alias("source_file_name"), F.lit("run").alias("run_id"),
        F.current_timestamp().alias("ingested_at"), F.try_parse_json("element").alias("service"),
    )
    return json_files.extract_services(services).drop("ingested_at")


@query("i01_content_hash")
def _(m, spark, sf_dir):
    """Fingerprint of every document from its lines, as for files too large for one value."""
    return files.fingerprint(testdata.document_lines(spark, sf_dir))


# Checks over rows as they were delivered, where each finds something.
mart("q00_check_run", lambda m: quality.check_run(
    m.fct_standard_charges_semantic, "semantic",
    {**quality.no_nulls("semantic_charge_sk", "hospital_id", "billing_code", "payer_name", "plan_name", "description"),
     **quality.only_values("rate_category", RATE_CATEGORIES),
     "no_other rate_category": F.col("rate_category") == "other"},
    unique=["semantic_charge_sk"],
    references=[quality.Reference("hospital_id", m.dim_hospital, "hospital_id")],
).unionByName(quality.check_run(
    m.dim_procedure, "procedures",
    {**quality.no_nulls("billing_code"), **quality.only_values("billing_code_type", KNOWN_CODE_TYPES)},
)))

DELIVERED_TYPES = ("negotiated_dollar", "gross_charge", "discounted_cash_price")


def registered_names(m):
    return m.csv_registry.select("source_file_name", "status").unionByName(
        m.json_registry.select("source_file_name", "status")
    ).filter("status = 'success'")


@query("q00_check_run_delivered")
def _(m, spark, sf_dir):
    return quality.check_run(
        source(spark, sf_dir, "charges"), "charges",
        {**quality.no_nulls("billing_code", "billing_code_type", "description", "payer_name", "plan_name", "rate_amount"),
         **quality.only_values("rate_type", DELIVERED_TYPES), **quality.only_values("billing_code_type", KNOWN_CODE_TYPES)},
        unique=["run_id", "raw_rate_json"],
        references=[quality.Reference("source_file_name", registered_names(m), "source_file_name")],
    )


@query("q01_not_null_delivered")
def _(m, spark, sf_dir):
    return quality.not_null(
        source(spark, sf_dir, "charges"), "billing_code", "billing_code_type", "description", "payer_name", "hospital_id")


@query("q02_unique_run")
def _(m, spark, sf_dir):
    return quality.unique(source(spark, sf_dir, "charges"), "run_id")


@query("q03_accepted_rate_types")
def _(m, spark, sf_dir):
    return quality.accepted_values(source(spark, sf_dir, "charges"), "rate_type", DELIVERED_TYPES)


@query("q04_file_relationship")
def _(m, spark, sf_dir):
    return quality.relationships(
        source(spark, sf_dir, "charges"), "source_file_name", registered_names(m), "source_file_name")


@query("q05_empty_class")
def _(m, spark, sf_dir):
    charges = source(spark, sf_dir, "charges")
    return quality.not_empty(charges.filter("billing_class is not null"), "classified_charges")


@query("q08_stated_prefixes")
def _(m, spark, sf_dir):
    stated = m.csv_registry.withColumn("hospital_name", F.get_json_object("preamble_kv", "$.hospital_name"))
    return quality.numeric_prefixes(stated.select(
        F.col("run_id").alias("hospital_id"), "hospital_name", F.col("hospital_name").alias("hospital_name_clean"),
        "source_file_name"))


@query("q09_invalid_delivered")
def _(m, spark, sf_dir):
    distinct = source(spark, sf_dir, "charges").select("billing_code", "billing_code_type").distinct()
    return quality.invalid_codes(charges=distinct)


mart("q10_other_semantic", lambda m: quality.other_category(m.fct_standard_charges_semantic))


@query("q11_wide_counts")
def _(m, spark, sf_dir):
    return quality.landing_counts(source(spark, sf_dir, "landing_wide"), "pt_csv_raw_wide")


@query("q11_document_counts")
def _(m, spark, sf_dir):
    """Raw JSON documents per file, one per order here."""
    documents = source(spark, sf_dir, "landing_json").select("source_file_name", "ingested_at", "run_id").distinct()
    return quality.landing_counts(documents, "pt_json_raw")


@query("q14_json_rows_wide")
def _(m, spark, sf_dir):
    return quality.json_rows(source(spark, sf_dir, "landing_wide"))


@query("m09_returning_keys")
def _(m, spark, sf_dir):
    """Keys of the target that come back on other days with other values, next to new keys and old rows."""
    loaded = m.fct_standard_charges.filter(F.col("ingested_at") < F.lit("1997-01-01"))
    returns = (F.col("ingested_at") < F.lit("1997-01-01")) & (F.col("rate_type") == "gross_charge")
    again = m.base.withColumns({
        "description": F.when(returns, "delivered again").otherwise(F.col("description")),
        "ingested_at": F.when(returns, F.expr("ingested_at + interval 3650 days")).otherwise(F.col("ingested_at")),
    })
    return facts.merge_charges(loaded, again, m.hospital_ids)


def _outcomes(spark, sf_dir):
    """Documents in the role of processed files; those with a doc_id divisible by 5 failed."""
    return _documents_as_files(spark, sf_dir).select(
        F.col("source_file_name").alias("source_path"), "file_hash",
        F.when(F.col("doc_id") % 5 == 0, "invalid JSON").alias("error_message"),
    )


@query("i04_manifest")
def _(m, spark, sf_dir):
    return files.manifest_rows(_outcomes(spark, sf_dir), "2024-01-01").drop("updated_at")


@query("i05_run_summary")
def _(m, spark, sf_dir):
    failed = F.col("error_message").isNotNull()
    return files.run_summary(_outcomes(spark, sf_dir).select(F.when(failed, "failed").otherwise("ingested").alias("outcome")))


@query("i06_encodings")
def _(m, spark, sf_dir):
    """Every third document gets a byte that is not UTF-8; encoding and length of each as text."""
    latin = F.expr("cast(substring(source_path, 5) as bigint) % 3 = 0 and line_no = 0")
    raw = testdata.document_lines(spark, sf_dir).withColumn(
        "bytes", F.when(latin, F.concat(F.expr("cast(X'E9' as string)"), "bytes")).otherwise(F.col("bytes")))
    known = raw.join(files.encodings(raw), "source_path")
    return known.groupBy("source_path", "encoding").agg(F.sum(F.length(files.decoded())).alias("n_chars"))


@query("i07_line_shapes")
def _(m, spark, sf_dir):
    """NDJSON or not: every document, and the event properties as 50 files."""
    props = testdata.table(spark, sf_dir, "events").select(
        F.expr("concat('events_', event_id % 50)").alias("source_path"), F.col("props").alias("bytes"))
    return json_files.line_shapes(testdata.document_lines(spark, sf_dir).select("source_path", "bytes").unionByName(props))


@query("i21_capped")
def _(m, spark, sf_dir):
    """The first thousand landing rows by hash."""
    rows = source(spark, sf_dir, "landing_tall").select("source_file_name", "raw")
    return json_files.capped(rows, 1000, F.md5(F.concat("source_file_name", "raw")))


@query("i26_routing")
def _(m, spark, sf_dir):
    """Registry rows of CSV files; of files with a number divisible by 5 no row was loaded."""
    raw = testdata.csv_lines(spark, sf_dir)
    profile = written(csv_files.landing_profile(raw))
    loaded = csv_files.landing_rows(raw, profile).filter("cast(split(source_file_name, '[.]')[0] as int) % 5 <> 0")
    rows = csv_files.registry_rows(profile, loaded, "run", F.current_timestamp())
    return rows.select("source_file_name", "run_id", "format_hint", "delimiter", "rows_loaded", "status", "error_message")

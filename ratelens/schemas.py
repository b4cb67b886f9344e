"""Schemas of the tables the pipeline writes and the contract the marts are checked against."""

from pyspark.sql import types as T

STAGED_CHARGE = (
    "hospital_name", "hospital_id", "billing_code", "billing_code_type", "description",
    "payer_name", "plan_name", "rate_type", "rate_amount", "billing_class", "gross_charge",
    "discounted_cash", "minimum", "maximum", "source_system", "source_file_name", "run_id",
    "ingested_at", "raw_rate_json",
)
SEMANTIC = (
    "semantic_charge_sk", "standard_charge_sk", "hospital_id", "hospital_name", "billing_code",
    "billing_code_raw", "billing_code_type", "description", "payer_name", "plan_name",
    "rate_category", "rate_amount", "rate_unit", "source_system", "source_file_name",
    "ingested_at", "contracting_method",
)
COMPARABLE = (
    "semantic_charge_sk", "standard_charge_sk", "hospital_id", "hospital_name",
    "billing_code_raw", "billing_code", "billing_code_type", "billing_code_is_valid",
    "billing_code_issue_reason", "description", "payer_name", "plan_name", "rate_category",
    "rate_amount", "rate_unit", "comparability_key", "is_comparable", "comparability_reason",
    "source_system", "source_file_name", "ingested_at", "contracting_method",
)
HARMONIZED = COMPARABLE[:12] + ("payer_family", "plan_family") + COMPARABLE[12:]
COMPARE_GRAIN = (
    "billing_code", "billing_code_type", "payer_family", "plan_family", "rate_category",
    "rate_unit", "comparability_key", "hospital_id",
)
COMPARE = COMPARE_GRAIN + (
    "min_rate", "max_rate", "approx_median_rate", "row_count", "last_ingested_at",
)
SILVER = (
    "source_file_name", "source_format", "ingest_date", "billing_code", "description",
    "rate_type", "rate_amount", "ingested_at", "payer_name", "plan_name",
)
SOURCE_SYSTEMS = ("json", "csv_tall", "csv_wide")

EXTRACTED_RATE = T.StructType(
    [
        T.StructField("source_file_name", T.StringType(), False),
        T.StructField("run_id", T.StringType()),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("record_path", T.StringType()),
        T.StructField("billing_code", T.StringType()),
        T.StructField("billing_code_type", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("payer", T.StringType()),
        T.StructField("plan", T.StringType()),
        T.StructField("negotiated_rate", T.DecimalType(38, 9)),
        T.StructField("rate_type", T.StringType()),
        T.StructField("billing_class", T.StringType()),
        T.StructField("payment_methodology", T.StringType()),
        T.StructField("payment_unit", T.StringType()),
        T.StructField("raw_rate", T.StringType()),
    ]
)
RAW_ROW = T.StructType(
    [
        T.StructField("source_file_name", T.StringType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("raw", T.StringType()),
    ]
)
CSV_REGISTRY = T.StructType(
    [
        T.StructField("source_file_name", T.StringType(), False),
        T.StructField("run_id", T.StringType()),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("format_hint", T.StringType()),
        T.StructField("header_count", T.LongType()),
        T.StructField("delimiter", T.StringType()),
        T.StructField("encoding", T.StringType()),
        T.StructField("row1_raw", T.StringType()),
        T.StructField("row2_raw", T.StringType()),
        T.StructField("preamble_kv", T.StringType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)
JSON_REGISTRY = T.StructType(
    [
        T.StructField("source_file_name", T.StringType(), False),
        T.StructField("local_path", T.StringType()),
        T.StructField("gcs_uri", T.StringType()),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_extracted", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("file_sha256", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)
MANIFEST = T.StructType(
    [
        T.StructField("source_path", T.StringType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("ingest_date", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("error_message", T.StringType()),
    ]
)
# Columns the published contract requires of a canonical rate table.
CONTRACT_COLUMNS = (
    "facility_id", "facility_name", "billing_code", "billing_code_type",
    "billing_code_description", "billing_class", "payer_id", "payer_name", "plan_id",
    "plan_name", "network_tier", "payment_methodology", "payment_unit", "price_type",
    "negotiated_rate", "negotiated_rate_min", "negotiated_rate_max", "currency",
    "billing_multiplier", "modifier_1", "modifier_2", "place_of_service", "contract_id",
    "contract_name", "effective_start_date", "effective_end_date", "source_file_name",
    "source_format", "source_row_id", "ingested_at", "normalization_status",
    "data_quality_issues",
)

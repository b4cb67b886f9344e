"""Landing tables to one deduplicated charge table."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions import blank_to_null
from ratelens.functions.codes import classify_code
from ratelens.functions.keys import amount_text, name_key, surrogate_key
from ratelens.functions.names import STAGING_NAME_KEYS, preamble_name
from ratelens.functions.rates import numeric
from ratelens.schemas import STAGED_CHARGE
from ratelens.sources.tables import written

# Header names under which landing rows carry each field, best first.
TALL_FIELDS = {
    "row_name": ("hospital_name",),
    "billing_code": ("billing_code", "code", "service_code"),
    "billing_code_type": ("billing_code_type", "code_type"),
    "description": ("description", "procedure_description"),
    "payer_name": ("payer_name", "payer"),
    "plan_name": ("plan_name", "plan"),
    "rate_type": ("rate_type", "standard_charge_type"),
    "rate_amount": ("estimated_amount", "negotiated_rate", "rate", "amount"),
    "billing_class": ("billing_class", "setting"),
    "gross_charge": ("gross_charge",),
    "discounted_cash": ("discounted_cash",),
    "minimum": ("minimum", "min"),
    "maximum": ("maximum", "max"),
}
WIDE_FIELDS = {
    "row_name": ("hospital_name",),
    "billing_code": ("code", "billing_code", "service_code", "CPT", "HCPCS"),
    "billing_code_type": ("billing_code_type", "code_type"),
    "description": ("description", "procedure_description", "Description"),
    "billing_class": ("billing_class", "setting"),
    "gross_charge": ("gross_charge",),
    "discounted_cash": ("discounted_cash",),
    "minimum": ("min",),
    "maximum": ("max",),
    "negotiated_dollar": ("negotiated_dollar",),
    "negotiated_percentage": ("negotiated_percentage",),
    "estimated_amount": ("estimated_amount",),
}
WIDE_RATES = ("negotiated_dollar", "negotiated_percentage", "estimated_amount")
AMOUNTS = {
    "rate_amount", "gross_charge", "discounted_cash", "minimum", "maximum", *WIDE_RATES,
}


def latest_per_file(registry: DataFrame) -> DataFrame:
    """The registry row of each file's newest run."""
    columns = [c for c in registry.columns if c != "source_file_name"]
    newest = F.max_by(F.struct(*columns), F.struct("ingested_at", "run_id"))
    return (
        registry.groupBy("source_file_name")
        .agg(newest.alias("newest"))
        .select("source_file_name", "newest.*")
    )


def registry_names(csv_registry: DataFrame) -> DataFrame:
    """Facility name per file as the CSV preamble states it, NULL where it does not."""
    return latest_per_file(csv_registry).select(
        "source_file_name",
        preamble_name("preamble_kv", STAGING_NAME_KEYS).alias("stated_name"),
    )


def _parse(landing: DataFrame, fields: dict[str, tuple[str, ...]]) -> DataFrame:
    """Fields of a JSON landing row; each row's text is parsed once."""
    keys = sorted({key for candidates in fields.values() for key in candidates})
    slot = {key: f"_json_{i}" for i, key in enumerate(keys)}
    parsed = landing.select("*", F.json_tuple("raw", *keys).alias(*[slot[k] for k in keys]))

    def field(name: str) -> Column:
        value = F.coalesce(*[F.col(slot[key]) for key in fields[name]])
        return (numeric(value) if name in AMOUNTS else value).alias(name)

    return parsed.select("source_file_name", "ingested_at", "raw", *[field(f) for f in fields])


def _with_stated_name(landing: DataFrame, csv_registry: DataFrame) -> DataFrame:
    joined = landing.join(registry_names(csv_registry), "source_file_name", "left")
    name = F.coalesce(blank_to_null("row_name"), "stated_name", "source_file_name")
    return joined.withColumn("hospital_name", name).withColumn(
        "hospital_id", name_key("hospital_name")
    )


def _staged(df: DataFrame, source_system: str) -> DataFrame:
    return df.withColumns(
        {
            "source_system": F.lit(source_system),
            "run_id": F.lit(None).cast("string"),
            "raw_rate_json": F.col("raw"),
        }
    ).select(*STAGED_CHARGE)


def stage_json_rates(extracted: DataFrame) -> DataFrame:
    """Rates extracted from JSON files; the file stands in for the facility."""
    missing = F.lit(None).cast("decimal(38,9)")
    return extracted.withColumns(
        {
            "hospital_name": F.col("source_file_name"),
            "hospital_id": name_key("source_file_name"),
            "payer_name": F.col("payer"),
            "plan_name": F.col("plan"),
            "rate_type": F.coalesce("rate_type", F.lit("negotiated_rate")),
            "rate_amount": numeric("negotiated_rate"),
            "gross_charge": missing,
            "discounted_cash": missing,
            "minimum": missing,
            "maximum": missing,
            "source_system": F.lit("json"),
            "raw_rate_json": F.col("raw_rate"),
        }
    ).select(*STAGED_CHARGE)


def stage_csv_tall(landing: DataFrame, csv_registry: DataFrame) -> DataFrame:
    """Tall CSV rows: one rate per row."""
    parsed = _parse(landing, TALL_FIELDS)
    parsed = parsed.withColumn(
        "rate_type", F.coalesce("rate_type", F.lit("estimated_amount"))
    )
    return _staged(_with_stated_name(parsed, csv_registry), "csv_tall")


def stage_csv_wide(landing: DataFrame, csv_registry: DataFrame) -> DataFrame:
    """Wide CSV rows: one row per rate column that holds an amount."""
    parsed = _with_stated_name(_parse(landing, WIDE_FIELDS), csv_registry)
    unknown = F.lit(None).cast("string")
    parsed = parsed.withColumns({"payer_name": unknown, "plan_name": unknown})
    kept = [c for c in parsed.columns if c not in WIDE_RATES]
    rates = parsed.unpivot(kept, list(WIDE_RATES), "rate_type", "rate_amount")
    return _staged(rates.filter(F.col("rate_amount").isNotNull()), "csv_wide")


def with_charge_key(charges: DataFrame) -> DataFrame:
    """Adds ``standard_charge_sk``: twelve parts that tell one published rate from another."""
    return charges.withColumn(
        "standard_charge_sk",
        surrogate_key(
            "source_system", "source_file_name", "ingested_at", "hospital_id", "billing_code",
            "billing_code_type", "payer_name", "plan_name", "rate_type",
            amount_text("rate_amount"), F.lit(""),
            F.coalesce("raw_rate_json", F.lit("{}")),
        ),
    )


# What may still differ between rows of one key; settles which of them is kept.
TIE_BREAKS = (
    "run_id", "description", "gross_charge", "discounted_cash", "minimum", "maximum",
    "billing_class", "hospital_name",
)


def newest_per_key(charges: DataFrame) -> DataFrame:
    """One row per key, the latest load first.

    The limit of one row per key is applied inside each map task before the shuffle, so a key that
    was delivered again and again reaches its reducer as one row per task.
    """
    order = [F.col(c).desc_nulls_last() for c in ("ingested_at", *TIE_BREAKS)]
    rank = F.row_number().over(Window.partitionBy("standard_charge_sk").orderBy(*order))
    return (
        charges.withColumn("_rank", rank)
        .filter("_rank = 1")
        .select("standard_charge_sk", *STAGED_CHARGE)
    )


# Hashes of repeated keys that are sent to every executor; with more of them all rows are shuffled.
REPEATED_KEYS = 500_000


def newest_of_written(keyed: DataFrame) -> DataFrame:
    """As ``newest_per_key``, over a written table with its keys.

    Hashes of keys are counted first. Only rows whose hash comes more than once are shuffled and ranked; the others
    have their key alone and stay where they are. Two keys of one hash are both ranked, by key.
    """
    mark = F.xxhash64("standard_charge_sk")
    repeated = written(
        keyed.groupBy(mark.alias("_mark")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_mark")
    )
    n = repeated.limit(REPEATED_KEYS + 1).count()
    if n == 0:
        return keyed.select("standard_charge_sk", *STAGED_CHARGE)
    if n > REPEATED_KEYS:
        return newest_per_key(keyed)
    marked, marks = keyed.withColumn("_mark", mark), F.broadcast(repeated)
    alone = marked.join(marks, "_mark", "left_anti").select("standard_charge_sk", *STAGED_CHARGE)
    return alone.unionByName(newest_per_key(marked.join(marks, "_mark", "left_semi")))


def _union(*staged: DataFrame) -> DataFrame:
    union = staged[0]
    for other in staged[1:]:
        union = union.unionByName(other)
    return union


def keyed_union(*staged: DataFrame) -> DataFrame:
    """Union of staged sources with their keys; a key may come several times."""
    return with_charge_key(_union(*staged))


def charge_base(*staged: DataFrame) -> DataFrame:
    """Union of staged sources, keyed and deduplicated."""
    return newest_per_key(keyed_union(*staged))


def written_charge_base(*staged: DataFrame) -> DataFrame:
    """``charge_base`` over rows written once, for marts that several branches read.

    A key is a hash of its row, a third of what the row takes on disk; it is made from the row as it is read.
    """
    return newest_of_written(with_charge_key(written(_union(*staged))))


# Bitmaps of 32,768 rows (4 KB each) that are sent to every executor; with more of them all rows are shuffled.
BITMAPS = 16_384


def _marked(numbered: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Rows whose number is set in ``bitmaps`` (bucket, bits); they stay where they are."""
    at = F.bitmap_bit_position("_row")
    byte = F.expr("substring(bits, cast(_at div 8 as int) + 1, 1)")
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return (
        numbered.withColumns({"bucket": F.bitmap_bucket_number("_row"), "_at": at})
        .join(F.broadcast(bitmaps), "bucket")
        .filter(value.bitwiseAND(F.expr("shiftleft(1, cast(_at % 8 as int))")) != 0)
        .select("standard_charge_sk", *STAGED_CHARGE)
    )


def newest_of_numbered(numbered: DataFrame) -> DataFrame:
    """As ``newest_per_key``, over a table with its keys that was written with a number a row, ``_row``.

    Only key, load and number of a row are shuffled. Who wins comes back as one bit a row, so whole rows stay where they
    are, however many keys repeat. Rows of a key that load time and run don't tell apart are shuffled and ranked whole.
    """
    order = [F.col(c).desc_nulls_last() for c in ("ingested_at", "run_id")]
    key = Window.partitionBy("_key")
    first = (
        numbered.select(F.unhex("standard_charge_sk").alias("_key"), "ingested_at", "run_id", "_row")
        .withColumn("_rank", F.rank().over(key.orderBy(*order)))
        .filter("_rank = 1")
        .select("_row", (F.count("*").over(key) > 1).alias("tied"))
    )
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("_row")).alias("bits")
    bitmaps = written(first.groupBy(F.bitmap_bucket_number("_row").alias("bucket"), "tied").agg(bits))
    sizes = {r.tied: r.n for r in bitmaps.groupBy("tied").agg(F.count("*").alias("n")).collect()}
    if sum(sizes.values()) > BITMAPS:
        return newest_per_key(numbered)
    alone = _marked(numbered, bitmaps.filter("not tied"))
    if not sizes.get(True):
        return alone
    return alone.unionByName(newest_per_key(_marked(numbered, bitmaps.filter("tied"))))


def redelivered_base(*staged: DataFrame) -> DataFrame:
    """``charge_base`` over rows written once, for deliveries that bring most keys again."""
    numbered = _union(*staged).withColumn("_row", F.monotonically_increasing_id())
    return newest_of_numbered(with_charge_key(written(numbered)))


def lake_base(silver: DataFrame) -> DataFrame:
    """Lake rows as charges: facility from the file name, code type guessed from the code."""
    path = F.lower(F.coalesce("source_file_name", F.lit("")))
    by_suffix = F.when(path.contains(".json"), "json").when(path.contains(".csv"), "csv")
    stem = F.regexp_replace("source_file_name", r"^.*[\\/]", "")
    stem = F.regexp_replace(stem, r"\.(csv|json|parquet)$", "")
    token = F.regexp_replace(F.regexp_replace(stem, r"^\d+_", ""), r"_standardcharges.*$", "")
    clean = F.lower(F.coalesce(blank_to_null("hospital_name"), F.lit("unknown")))
    return (
        silver.withColumns(
            {
                "source_format": F.coalesce("source_format", by_suffix),
                "hospital_token": token,
                "hospital_name": F.trim(F.regexp_replace(token, "_+", " ")),
            }
        )
        .withColumns(
            {
                "hospital_name_clean": clean,
                "hospital_name_norm": F.regexp_replace(clean, "[^a-z0-9]+", " "),
                "hospital_id": F.md5(clean),
                "source_system": F.when(
                    F.lower("source_format").contains("json"), "json"
                ).otherwise("csv_wide"),
                "billing_code_type": classify_code("billing_code"),
                "raw_rate_json": F.lit(None).cast("string"),
            }
        )
        .withColumn(
            "standard_charge_sk",
            surrogate_key(
                "source_system", "source_file_name", "ingested_at", "hospital_id",
                "billing_code", "rate_type", amount_text("rate_amount"),
            ),
        )
    )


def base_of(kind: str, *, landing=None, silver=None) -> DataFrame:
    """The charge base of a run: ``landing`` (staged frames) or ``silver`` (lake rows)."""
    if kind == "landing":
        return charge_base(*landing)
    if kind == "silver":
        return lake_base(silver)
    raise ValueError(f"unknown base: {kind}")

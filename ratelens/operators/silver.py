"""Lake files to one row per rate, with every rejected row kept and explained."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions import blank_to_null, bound, first_present, text
from ratelens.functions.jsonx import (
    as_text,
    first_of,
    first_truthy,
    items,
    members,
    number,
    present,
    top_level,
    truthy_text,
)
from ratelens.functions.rates import finite, parse_rate, strict_amount
from ratelens.schemas import SILVER

# Top-level keys that hold the list of charge items.
CHARGE_KEYS = ("standardCharges", "standard_charge_information")
# Where an item's code information keeps the code.
CODE_KEYS = (
    "billing_code", "billingCode", "code_information_code", "code_value", "code", "cpt", "hcpcs",
)
# Rate keys of a flat item, a nested item and a tabular row, with their rate types.
FLAT_RATES = {
    "negotiated_rate": "NEGOTIATED",
    "standard_charge": "STANDARD",
    "gross_charge": "GROSS",
    "cash_discount": "CASH",
}
NESTED_RATES = (
    "negotiated_rate", "gross_charge", "discounted_cash_price", "minimum", "maximum",
)
PAYER_AMOUNTS = ("standard_charge_dollar", "negotiated_rate", "standard_charge")
PAYER_KEYS = ("payer_name", "payer")
PLAN_KEYS = ("plan_name", "plan")
ITEM_KEYS = (
    "code", "billing_code", "description", *PAYER_KEYS, *PLAN_KEYS, *FLAT_RATES,
    "code_information", "standard_charges",
)
TABULAR_RATES = {
    "negotiated_rate": "NEGOTIATED",
    "standard_charge": "STANDARD",
    "gross_charge": "GROSS",
    "discounted_cash_price": "CASH",
}
TABULAR_FIELDS = {
    "billing_code": ("billing_code", "code", "Billing Code"),
    "description": ("description", "Description"),
    "payer_name": ("payer_name", "payer", "Payer Name", "Payer"),
    "plan_name": ("plan_name", "plan", "Plan Name", "Plan"),
}
PAYLOAD_COLUMN = "payload_json"


def _no_text() -> Column:
    return F.lit(None).cast("string")


def _rate(rate_type, amount: Column, payer: Column, plan: Column) -> Column:
    """A rate, NULL when it has no amount."""

    def row(known: Column) -> Column:
        return F.struct(
            (F.lit(rate_type) if isinstance(rate_type, str) else rate_type).alias("rate_type"),
            known.alias("rate_amount"),
            payer.alias("payer_name"),
            plan.alias("plan_name"),
            _no_text().alias("reject"),
        )

    return bound(amount, lambda known: F.when(known.isNotNull(), row(known)))


def _reject(reason: str) -> Column:
    return F.struct(
        _no_text().alias("rate_type"),
        F.lit(None).cast("double").alias("rate_amount"),
        _no_text().alias("payer_name"),
        _no_text().alias("plan_name"),
        F.lit(reason).alias("reject"),
    )


def _meta(bronze: DataFrame) -> list[Column]:
    date = F.col("ingest_date").cast("string")
    return [
        text("source_path").alias("source_file_name"),
        F.coalesce("source_format", "_source_system").alias("source_format"),
        date.alias("ingest_date"),
        F.concat(date, F.lit("T00:00:00")).alias("ingested_at"),
    ]


def validation_reason(file_name="source_file_name", code="billing_code", amount="rate_amount"):
    """The first rule a rate breaks, NULL when it is good."""
    value = F.col(amount).cast("double")
    return (
        F.when(text(file_name) == "", "missing_source_file_name")
        .when(F.trim(text(code)) == "", "MISSING_CODE")
        .when(F.col(amount).isNull(), "MISSING_RATE")
        .when(F.isnan(value) | (value < 0), "BAD_RATE_VALUE")
    )


def _finish(rows: DataFrame) -> DataFrame:
    """Silver columns with the structural reason, else the first broken rule."""
    return rows.select(
        *SILVER, F.coalesce("reject", validation_reason()).alias("reason_code")
    )


def _column(df: DataFrame, *names: str) -> list[Column]:
    return [F.col(f"`{n}`") for n in names if n in df.columns]


def tabular_rates(bronze: DataFrame) -> DataFrame:
    """Rates of tabular rows; a row without any rate becomes one rejected row."""
    fields = {name: _column(bronze, *aliases) for name, aliases in TABULAR_FIELDS.items()}

    def field(name: str) -> Column:
        return first_present(*fields[name]) if fields[name] else _no_text()

    by_lower = {c.lower(): c for c in reversed(bronze.columns)}
    payer, plan = field("payer_name"), field("plan_name")
    rates = [
        _rate(rate_type, strict_amount(F.col(f"`{by_lower[name]}`")), payer, plan)
        for name, rate_type in TABULAR_RATES.items()
        if name in by_lower
    ]
    described = [F.when(c != "", c) for c in fields["description"]]
    description = F.coalesce(*described, F.lit("")) if described else F.lit("")
    none = F.array(_reject("MISSING_RATE"))
    found = F.array_compact(F.array(*rates)) if rates else F.filter(none, lambda _: F.lit(False))
    empty = F.size("_rates") == 0
    raw_code = [F.when(c != "", c) for c in fields["billing_code"]]
    raw_text = fields["description"][0] if fields["description"] else _no_text()
    return _finish(
        bronze.select(
            *_meta(bronze),
            F.coalesce(field("billing_code"), F.lit("")).alias("_code"),
            (F.coalesce(*raw_code) if raw_code else _no_text()).alias("_raw_code"),
            description.alias("_text"),
            raw_text.alias("_raw_text"),
            found.alias("_rates"),
        ).select(
            "source_file_name", "source_format", "ingest_date", "ingested_at",
            F.when(empty, F.col("_raw_code")).otherwise(F.col("_code")).alias("billing_code"),
            F.when(empty, F.col("_raw_text")).otherwise(F.col("_text")).alias("description"),
            F.inline(F.when(empty, none).otherwise(F.col("_rates"))),
        )
    )


def _fields(struct, names) -> list[Column]:
    return [struct[n] for n in names]


def _code_text(value: Column) -> Column:
    """A code, or the ``value`` or ``code`` of a dictionary that wraps it."""

    def shown(inner: Column) -> Column:
        wrapped = F.coalesce(truthy_text(inner["value"]), as_text(inner["code"]))
        return F.when(inner.isNotNull(), wrapped).otherwise(as_text(value))

    return bound(bound(members(value, "value", "code"), shown), blank_to_null)


def _amount(value: Column) -> Column:
    """A JSON number as it is, text by the rule for free-text cells."""

    def read(own: Column) -> Column:
        return F.coalesce(bound(number(own), finite), bound(as_text(own), parse_rate))

    return bound(value, read)


def _held(amounts) -> Column:
    """Those of an item's rate keys that it has; most have few, and an absent one costs as much to read."""
    return F.filter(amounts, lambda r: r["value"].isNotNull())


def _nested_rates(charges: Column, payer: Column, plan: Column) -> Column:
    """Rates of ``standard_charges[]``: one per payer entry and one per rate key."""

    def of_payer(entry: Column) -> Column:
        return _rate(
            "NEGOTIATED",
            _amount(first_truthy(_fields(entry, PAYER_AMOUNTS))),
            bound(first_of(_fields(entry, PAYER_KEYS), truthy_text), blank_to_null),
            bound(first_of(_fields(entry, PLAN_KEYS), truthy_text), blank_to_null),
        )

    def of_charge(charge: Column) -> Column:
        own = F.array(
            *[
                F.struct(F.lit(key.upper()).alias("kind"), charge[key].alias("value"))
                for key in NESTED_RATES
            ]
        )
        rates = F.transform(
            _held(own), lambda r: _rate(r["kind"], _amount(r["value"]), payer, plan)
        )
        entries = F.transform(
            items(charge["payers_information"]),
            lambda entry: bound(members(entry, *PAYER_AMOUNTS, *PAYER_KEYS, *PLAN_KEYS), of_payer),
        )
        return F.concat(rates, F.coalesce(entries, F.array()))

    shaped = F.transform(charges, lambda c: members(c, *NESTED_RATES, "payers_information"))
    return F.array_compact(F.flatten(F.transform(F.array_compact(shaped), of_charge)))


META = ("source_file_name", "source_format", "ingest_date", "ingested_at")


def payload_rates(bronze: DataFrame) -> DataFrame:
    """Rates of rows that hold one JSON document each.

    A document is parsed once into its items and each item into its known members; elements that
    are no objects have no members, so they give no rate. A filter for them would be moved below the
    members and read every item twice.
    """
    documents = bronze.select(
        *_meta(bronze), items(top_level(F.col(PAYLOAD_COLUMN), *CHARGE_KEYS)).alias("_items")
    )
    found = documents.select(
        *META, F.col("_items").isNull().alias("_unsupported"), F.explode_outer("_items").alias("_i")
    ).select(*META, "_unsupported", members("_i", *ITEM_KEYS).alias("_item"))
    item = F.col("_item")
    read = (
        found.select(
            *META,
            "_unsupported",
            (present(item["code_information"]) & present(item["standard_charges"])).alias(
                "_nested"
            ),
            F.coalesce(
                F.try_variant_get(item["code_information"], "$[0]", "variant"),
                item["code_information"],
            ).alias("_information"),
            items(item["standard_charges"]).alias("_charges"),
            first_of(_fields(item, PAYER_KEYS), truthy_text).alias("_payer"),
            first_of(_fields(item, PLAN_KEYS), truthy_text).alias("_plan"),
            F.coalesce(truthy_text(item["code"]), as_text(item["billing_code"])).alias("_flat"),
            F.coalesce(as_text(item["description"]), F.lit("")).alias("_text"),
            F.array(
                *[
                    F.struct(F.lit(kind).alias("kind"), item[key].alias("value"))
                    for key, kind in FLAT_RATES.items()
                ]
            ).alias("_amounts"),
        )
        .withColumns(
            {
                "_information": members("_information", *CODE_KEYS),
                "_payer": F.trim("_payer"),
                "_plan": F.trim("_plan"),
            }
        )
        .withColumn("_code", first_of(_fields(F.col("_information"), CODE_KEYS), _code_text))
    )
    payer, plan = F.col("_payer"), F.col("_plan")
    flat = F.array_compact(
        F.transform(
            _held("_amounts"), lambda r: _rate(r["kind"], _amount(r["value"]), payer, plan)
        )
    )
    rates = (
        F.when(F.col("_unsupported"), F.array(_reject("JSON_UNSUPPORTED_SHAPE")))
        .when(~F.col("_nested"), flat)
        .when(F.col("_code").isNull(), F.array(_reject("MISSING_CODE")))
        .when(F.coalesce(F.size("_charges"), F.lit(0)) <= 0, F.array(_reject("MISSING_RATE")))
        .otherwise(_nested_rates(F.col("_charges"), payer, plan))
    )
    code = F.when(F.col("_nested"), F.col("_code")).otherwise(F.trim(text("_flat")))
    known = ~F.col("_unsupported")
    return _finish(
        read.select(
            *META,
            F.when(known, code).alias("billing_code"),
            F.when(known, F.col("_text")).alias("description"),
            F.inline(rates),
        )
    )


def candidate_rates(bronze: DataFrame) -> DataFrame:
    """Every rate or reject of a Bronze frame with its ``reason_code``, NULL for a good rate."""
    if "_source_system" not in bronze.columns:
        bronze = bronze.withColumn("_source_system", F.lit("json"))
    if PAYLOAD_COLUMN not in bronze.columns:
        return tabular_rates(bronze)
    has_payload = F.trim(text(PAYLOAD_COLUMN)) != ""
    documents = payload_rates(bronze.filter(has_payload)).withColumn("branch", F.lit("JSON"))
    rows = tabular_rates(bronze.filter(~has_payload)).withColumn("branch", F.lit("CSV/tabular"))
    return documents.unionByName(rows)


def good_rates(candidates: DataFrame) -> DataFrame:
    return candidates.filter(F.col("reason_code").isNull()).select(*SILVER)


def quarantined(candidates: DataFrame) -> DataFrame:
    return candidates.filter(F.col("reason_code").isNotNull()).select(*SILVER, "reason_code")


def quality_metrics(candidates: DataFrame) -> DataFrame:
    """Totals, quarantine rate and null rates of the good rows, as one row."""
    good = F.col("reason_code").isNull()
    total, kept = F.count("*"), F.count_if(good)

    def null_rate(column: str) -> Column:
        return F.round(
            F.try_divide(F.count_if(good & F.col(column).isNull()), kept), 4
        ).alias(f"null_rate_{column}")

    return candidates.agg(
        total.alias("total_rows"),
        kept.alias("good_rows"),
        (total - kept).alias("quarantine_rows"),
        F.coalesce(F.round(F.try_divide(total - kept, total), 4), F.lit(0.0)).alias(
            "quarantine_rate"
        ),
        null_rate("billing_code"),
        null_rate("rate_amount"),
    )


def quarantine_reasons(candidates: DataFrame) -> DataFrame:
    """Why rows of tabular files were rejected."""
    tabular = F.lower(text("source_format")).isin("csv", "csv_tall")
    return (
        candidates.filter(F.col("reason_code").isNotNull() & tabular)
        .groupBy("reason_code")
        .agg(F.count("*").alias("row_count"))
    )


def rows_by_source(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("_source_system").agg(F.count("*").alias("row_count"))


def good_rows_by_branch(candidates: DataFrame) -> DataFrame:
    return (
        candidates.filter(F.col("reason_code").isNull())
        .groupBy("branch")
        .agg(F.count("*").alias("row_count"))
    )


def candidate_nulls(candidates: DataFrame) -> DataFrame:
    """Share of rates without a code or an amount, among all that have a rate type."""
    rates = candidates.filter(F.col("rate_type").isNotNull())
    n = F.count("*")

    def share(condition: Column) -> Column:
        return F.round(F.lit(100.0) * F.count_if(condition) / n, 2)

    return rates.agg(
        n.alias("candidate_rows"),
        share(blank_to_null("billing_code").isNull()).alias("pct_null_billing_code"),
        share(F.col("rate_amount").isNull()).alias("pct_null_rate_amount"),
    )


def rate_type_counts(candidates: DataFrame, limit: int = 10) -> DataFrame:
    """The most frequent rate types."""
    return (
        candidates.filter(F.col("rate_type").isNotNull())
        .groupBy("rate_type")
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), "rate_type")
        .limit(limit)
    )


def gate(metrics: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The metrics row when too much was quarantined, else nothing."""
    return metrics.filter(F.col("quarantine_rate") > threshold)


def require_quality(metrics: DataFrame, threshold: float = 0.5) -> None:
    """Stop the run when too much was quarantined."""
    failed = gate(metrics, threshold).first()
    if failed:
        raise ValueError(f"quarantine rate {failed['quarantine_rate']} exceeds {threshold}")

"""Facts: charges, categorised rates, comparable rates and rejects."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions import text
from ratelens.functions.codes import code_type_or_unknown, issue_of, stored_form
from ratelens.functions.keys import surrogate_key
from ratelens.functions.names import match_text
from ratelens.functions.rates import (
    TYPED_COLUMNS,
    category_of,
    comparability_key,
    comparability_reason,
    lake_rate_category,
    rate_type_norm,
    unit_of,
)
from ratelens.operators.dims import with_families, with_hospital_id
from ratelens.operators.staging import REPEATED_KEYS, newest_of_written, newest_per_key
from ratelens.schemas import COMPARABLE, HARMONIZED, SEMANTIC, SOURCE_SYSTEMS, STAGED_CHARGE
from ratelens.sources.tables import broadcast_if_small, written


def standard_charges(base: DataFrame, hospitals: DataFrame) -> DataFrame:
    """The base with the hospital id of the dimension.

    The base is unique on ``standard_charge_sk`` and the lookup on file, so the result is unique
    without a second shuffle.
    """
    return with_hospital_id(base, hospitals).select(
        "standard_charge_sk", *STAGED_CHARGE
    )


def newer_charges(base: DataFrame, newest, hospitals: DataFrame) -> DataFrame:
    """Charges of the base loaded after ``newest`` (all of them where it is None), each key once.

    The base may hold a key several times (``keyed_union``): as ``newest`` is a literal, older rows are left out in
    the scan, before the one dedupe.
    """
    fresh = base if newest is None else base.filter(F.col("ingested_at") > F.lit(newest))
    return standard_charges(newest_per_key(fresh), hospitals)


def merge_charges(target: DataFrame, base: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Charges after an incremental load: base rows newer than the target replace or join it."""
    newest = target.agg(F.max("ingested_at")).first()[0]  # one value
    newer = base if newest is None else base.filter(F.col("ingested_at") > F.lit(newest))
    fresh = standard_charges(newest_of_written(written(newer)), hospitals)
    return _without(target, fresh.select("standard_charge_sk")).unionByName(fresh)


def _without(target: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the target whose key is not among ``keys``.

    Hashes of the keys on both sides meet first, so that rows are shuffled only if many keys return.
    """
    mark = F.xxhash64("standard_charge_sk").alias("_mark")
    returning = written(target.select(mark).join(keys.select(mark), "_mark", "left_semi").distinct())
    n = returning.limit(REPEATED_KEYS + 1).count()
    if n == 0:
        return target
    if n > REPEATED_KEYS:
        return target.join(keys, "standard_charge_sk", "left_anti")
    # At most as many rows as hashes return; keys of one hash are told apart by the second join.
    marks = F.broadcast(returning)
    met = F.broadcast(written(keys.withColumn("_mark", mark).join(marks, "_mark", "left_semi").drop("_mark")))
    return target.join(met, "standard_charge_sk", "left_anti")


def lake_standard_charges(base: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Lake rows with the amount repeated in the typed column its rate type names.

    ``base`` is a written table: its keys are counted before the few rows of repeated ones are shuffled.
    """
    kind = F.upper("rate_type")
    typed = {
        "gross_charge": kind == "GROSS_CHARGE",
        "discounted_cash": kind.isin("CASH", "DISCOUNTED_CASH_PRICE"),
        "minimum": kind == "MINIMUM",
        "maximum": kind == "MAXIMUM",
    }
    system = F.lower(F.trim("source_system"))
    wide = base.withColumns(
        {
            **{name: F.when(is_typed, F.col("rate_amount")) for name, is_typed in typed.items()},
            "billing_class": F.lit(None).cast("string"),
            "run_id": F.lit(None).cast("string"),
            "source_system": F.when(system.isin(*SOURCE_SYSTEMS), system).otherwise("csv_wide"),
        }
    )
    ids = broadcast_if_small(written(hospitals.groupBy("source_file_name").agg(F.min("hospital_id").alias("_dim_id"))))
    joined = wide.join(ids, "source_file_name", "left").withColumn(
        "hospital_id", F.coalesce("_dim_id", surrogate_key("source_file_name"))
    )
    return newest_of_written(joined)


def _rate(category: Column | str, amount: str, unit: Column | str, emitted: Column) -> Column:
    return F.when(
        emitted,
        F.struct(
            (F.lit(category) if isinstance(category, str) else category).alias("rate_category"),
            F.col(amount).alias("rate_amount"),
            (F.lit(unit) if isinstance(unit, str) else unit).alias("rate_unit"),
        ),
    )


def _present(amount: str) -> Column:
    return F.col(amount).isNotNull() & (F.col(amount) != 0)


def semantic_charges(base: DataFrame, hospitals: DataFrame) -> DataFrame:
    """One row per charge and rate category.

    All rates of a charge come from its own row, so they are emitted and deduplicated in one pass
    over the base; when the charge's own rate already has a typed column's category it wins.
    """
    charges = with_hospital_id(
        base.filter(F.col("billing_code").isNotNull()), hospitals
    ).withColumns(
        {"_type": rate_type_norm("rate_type"), "_kind": F.lower(text("rate_type"))}
    ).withColumn(
        "_category",
        F.when(
            _present("rate_amount"),
            category_of(
                "_type", "rate_amount", "gross_charge", "discounted_cash", "minimum", "maximum"
            ),
        ),
    )
    rates = [_rate(F.col("_category"), "rate_amount", unit_of("_type"),
                   F.col("_category").isNotNull())]
    for category, (amount, own_types) in TYPED_COLUMNS.items():
        taken = F.col("_category").eqNullSafe(category)
        rates.append(
            _rate(category, amount, "dollars",
                  _present(amount) & ~F.col("_kind").isin(*own_types) & ~taken)
        )
    return charges.select(
        "standard_charge_sk", "hospital_id", "hospital_name", "billing_code",
        F.col("billing_code").alias("billing_code_raw"),
        code_type_or_unknown("billing_code_type").alias("billing_code_type"),
        "description", "payer_name", "plan_name", "source_system", "source_file_name",
        "ingested_at",
        F.lit(None).cast("string").alias("contracting_method"),
        F.inline(F.array_compact(F.array(*rates))),
    ).withColumn(
        "semantic_charge_sk", surrogate_key("standard_charge_sk", "rate_category")
    ).select(*SEMANTIC)


def lake_semantic_charges(charges: DataFrame) -> DataFrame:
    """One row per lake charge, all in dollars."""
    return (
        charges.filter(_present("rate_amount"))
        .withColumns(
            {
                "billing_code_raw": F.col("billing_code"),
                "billing_code_type": code_type_or_unknown("billing_code_type"),
                "rate_category": lake_rate_category("rate_type"),
                "rate_unit": F.lit("dollars"),
                "contracting_method": F.lit(None).cast("string"),
            }
        )
        .withColumn("semantic_charge_sk", surrogate_key("standard_charge_sk", "rate_category"))
        .select(*SEMANTIC)
    )


def comparable_rates(semantic: DataFrame) -> DataFrame:
    """Rates with a normalised code, its validity and whether they may be compared.

    The semantic fact already holds the code type in its normalised form.
    """
    return (
        semantic.filter(F.col("rate_category").isNotNull() & _present("rate_amount"))
        .withColumns(
            {
                "billing_code_raw": F.coalesce("billing_code_raw", "billing_code"),
            }
        )
        .withColumn("billing_code", stored_form("billing_code_type", "billing_code_raw"))
        .withColumns(
            {
                "billing_code_issue_reason": issue_of("billing_code_type", "billing_code_raw"),
                "comparability_key": comparability_key(
                    "billing_code_type", "rate_category", "rate_unit"
                ),
                "comparability_reason": comparability_reason("rate_category"),
            }
        )
        .withColumns(
            {
                "billing_code_is_valid": F.col("billing_code_issue_reason").isNull(),
                "is_comparable": F.col("comparability_reason") == "comparable",
                "rate_category": F.lower(F.trim("rate_category")),
            }
        )
        .select(*COMPARABLE)
    )


def harmonized_rates(
    comparable: DataFrame, payer_map: DataFrame, plan_map: DataFrame
) -> DataFrame:
    """Comparable rates with payer and plan families.

    A family depends on the match form of the names and the seed maps alone, so it is looked up in
    the seeds directly; no dimension has to be built or shuffled for it.
    """
    named = comparable.withColumns(
        {
            "payer_name_norm": match_text("payer_name"),
            "plan_name_norm": match_text("plan_name"),
        }
    )
    return with_families(named, payer_map, plan_map).select(*HARMONIZED)


def harmonized_by_dimension(comparable: DataFrame, families: DataFrame) -> DataFrame:
    """As ``harmonized_rates``, over a written payer dimension.

    The dimension is unique on the raw names, so the join neither multiplies rates nor has to
    normalise a name per rate.
    """
    pairs = families.select(
        F.col("payer_name_raw").alias("_payer_raw"), F.col("plan_name_raw").alias("_plan_raw"),
        "payer_family", "plan_family",
    )
    match = (F.coalesce("payer_name", F.lit("")) == F.col("_payer_raw")) & (
        F.coalesce("plan_name", F.lit("")) == F.col("_plan_raw")
    )
    return (
        comparable.join(pairs, match, "left")
        .withColumns(
            {
                "payer_family": F.coalesce("payer_family", match_text("payer_name")),
                "plan_family": F.coalesce("plan_family", match_text("plan_name")),
            }
        )
        .select(*HARMONIZED)
    )


def newest_rejects(comparable: DataFrame, limit: int | None = None) -> DataFrame:
    """Rates that may not be compared: all of them, or the ``limit`` most recent.

    A limit this large would bring that many rows of every task to one place, so counts per day
    first tell which days can hold the newest rows, and only those are sorted.
    """
    rejects = comparable.filter(~F.col("is_comparable"))
    unused = (
        "billing_code_raw", "billing_code_is_valid", "billing_code_issue_reason",
        "comparability_key", "is_comparable",
    )
    if limit is None:
        return rejects.drop(*unused)
    day = F.to_date("ingested_at")
    newer = Window.orderBy(F.col("day").desc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    # The window runs over one row per calendar day.
    enough = (
        rejects.groupBy(day.alias("day"))
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(newer))
        .filter(F.col("upto") >= limit)
    )
    oldest = enough.agg(F.max("day")).scalar()
    return (
        rejects.filter(oldest.isNull() | (day >= oldest))
        .orderBy(F.col("ingested_at").desc_nulls_last(), "semantic_charge_sk")
        .limit(limit)
        .drop(*unused)
    )


def billing_code_rejects(comparable: DataFrame) -> DataFrame:
    """Invalid codes with how many rates carry them."""
    return (
        comparable.filter(F.col("billing_code_issue_reason").isNotNull())
        .groupBy("billing_code_raw", "billing_code_type", "billing_code_issue_reason")
        .agg(F.count("*").alias("row_count"))
        .select(F.lit("fct_rates_comparable").alias("source_layer"), "*")
        .orderBy(F.desc("row_count"), "billing_code_raw", "billing_code_type")
    )

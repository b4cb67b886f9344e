"""Aggregates that compare hospitals, payers and plans."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.operators.median import HOT_GROUP, by_size, counted_charges, summarised, valued
from ratelens.schemas import COMPARE, COMPARE_GRAIN


def packed(name: str) -> Column:
    """An id as bytes: what is lower-case hex at half its size behind a 1, any other text as it is behind a 0."""
    own, half = F.col(name), F.unhex(name)
    return F.when(F.lower(F.hex(half)) == own, F.concat(F.lit(b"\x01"), half)).when(
        own.isNotNull(), F.concat(F.lit(b"\x00"), own.cast("binary"))
    )


def unpacked(name: str) -> Column:
    """The id that ``packed`` made into bytes."""
    rest = F.expr(f"substring({name}, 2)")
    is_hex = F.expr(f"substring({name}, 1, 1)") == F.lit(b"\x01")
    return F.when(is_hex, F.lower(F.hex(rest))).otherwise(rest.cast("string"))


# Between the texts of a packed tail; one that a text holds itself is escaped.
PART, ESCAPE = "\x01", "\x02"


def joined(*names: str) -> Column:
    """Text columns, nulls included, as one text; ``parted`` gives them back."""

    def own(name: str) -> Column:
        escaped = F.replace(F.replace(F.col(name), F.lit(ESCAPE), F.lit(f"{ESCAPE}b")), F.lit(PART), F.lit(f"{ESCAPE}a"))
        return F.coalesce(escaped, F.lit(f"{ESCAPE}n"))

    return F.concat_ws(PART, *[own(name) for name in names])


def parted(name: str, *parts: str) -> list[Column]:
    """The columns that ``joined`` made into one, by name."""

    def own(i: int) -> Column:
        part = F.split(name, PART, -1)[i]
        plain = F.replace(F.replace(part, F.lit(f"{ESCAPE}a"), F.lit(PART)), F.lit(f"{ESCAPE}b"), F.lit(ESCAPE))
        return F.when(part != f"{ESCAPE}n", plain)

    return [own(i).alias(part) for i, part in enumerate(parts)]


#: What the rates of a charge share, by which they are dealt; the rest of the grain goes along as one text.
DEALT_BY = ("billing_code", "hospital_id", "payer_family", "plan_family")
TAIL = tuple(c for c in COMPARE_GRAIN if c not in DEALT_BY)


def hospital_procedure_compare(harmonized: DataFrame, exact: bool = False, hot: int = HOT_GROUP) -> DataFrame:
    """Rates that may be compared, per hospital, procedure, payer, plan and rate type.

    The median is a sketch by default; ``exact`` ranks the values instead. Most groups have few rates, of which partial
    results are larger than the rates themselves: a rate is shuffled as it is, its hospital id as bytes and the names
    of its group as one text. Those of a hospital's procedures with ``hot`` rates and more meet as partial results.
    """
    grain = [*DEALT_BY, "_tail"]
    rates = (
        harmonized.filter(F.coalesce("is_comparable", F.lit(False)))
        .filter(F.coalesce("billing_code_is_valid", F.lit(False)))
        .withColumn("rate_category", F.lower(F.trim("rate_category")))
        .filter("rate_category <> 'other'")
    )
    among, least = (harmonized, hot) if exact else counted_charges(harmonized, hot)
    # Rates of a charge stand side by side in what is shuffled when they are dealt by what they share.
    usual, large = [
        part.withColumns({"hospital_id": packed("hospital_id"), "_tail": joined(*TAIL)}).select(*grain, "rate_amount", "ingested_at")
        for part in by_size(rates, list(DEALT_BY), least, among)
    ]
    usual = usual.repartition(*DEALT_BY)
    if exact:
        found = summarised(*[valued(part, grain, "rate_amount", "ingested_at") for part in (usual, large)], grain).select(
            *grain,
            F.col("lowest").alias("min_rate"),
            F.col("highest").alias("max_rate"),
            F.col("median").alias("approx_median_rate"),
            "row_count",
            F.col("latest").alias("last_ingested_at"),
        )
    else:
        found = _compared(usual, grain).unionByName(_compared(large, grain))
    found = found.withColumn("hospital_id", unpacked("hospital_id"))
    return found.select("*", *parted("_tail", *TAIL)).select(*COMPARE)


def _compared(rates: DataFrame, grain: list[str]) -> DataFrame:
    return rates.groupBy(*grain).agg(
        F.min("rate_amount").alias("min_rate"),
        F.max("rate_amount").alias("max_rate"),
        F.percentile_approx("rate_amount", F.lit(0.5), F.lit(10000)).alias("approx_median_rate"),
        F.count("*").alias("row_count"),
        F.max("ingested_at").alias("last_ingested_at"),
    )


def payer_plan_compare(compare: DataFrame) -> DataFrame:
    """The same rows read from the payer's side."""
    return compare.select(*COMPARE)

"""The marts of one run, in dependency order."""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.functions import text
from ratelens.operators import aggs, dims, facts
from ratelens.plans import testdata
from ratelens.sources import seeds
from ratelens.sources.tables import broadcast_if_small, is_small, written


class Marts:
    """Every mart as a lazy frame over a charge base and the two registries.

    ``base`` may be a function that builds the base; it is called once, by the first mart that reads it.
    """

    def __init__(
        self,
        base: DataFrame | Callable[[], DataFrame],
        csv_registry: DataFrame,
        json_registry: DataFrame,
        payer_map: DataFrame | None = None,
        plan_map: DataFrame | None = None,
    ):
        spark = csv_registry.sparkSession
        self._base = base
        self.csv_registry = csv_registry
        self.json_registry = json_registry
        self.payer_map = payer_map if payer_map is not None else seeds.payer_map(spark)
        self.plan_map = plan_map if plan_map is not None else seeds.plan_map(spark)

    @cached_property
    def base(self) -> DataFrame:
        return self._base() if callable(self._base) else self._base

    @cached_property
    def hospital_lookup(self) -> DataFrame:
        return dims.hospital_lookup(self.csv_registry, self.json_registry)

    @cached_property
    def hospital_ids(self) -> DataFrame:
        """File and hospital id of the lookup, written and broadcast where files are few, so that rates need not be
        shuffled by file. Spark's own limit for a broadcast is in bytes and far below what executors can hold.
        """
        if not callable(self._base):
            return self.hospital_lookup
        return broadcast_if_small(written(self.hospital_lookup.select("source_file_name", "hospital_id")))

    @cached_property
    def dim_hospital(self) -> DataFrame:
        return dims.dim_hospital(self.base, self.hospital_lookup)

    @cached_property
    def dim_payer(self) -> DataFrame:
        return dims.dim_payer(self.base)

    @cached_property
    def dim_payer_harmonized(self) -> DataFrame:
        return dims.dim_payer_harmonized(self.dim_payer, self.payer_map, self.plan_map)

    @cached_property
    def dim_procedure(self) -> DataFrame:
        return dims.dim_procedure(self.base)

    @cached_property
    def dim_source_file(self) -> DataFrame:
        return dims.dim_source_file(self.csv_registry, self.json_registry)

    @cached_property
    def fct_standard_charges(self) -> DataFrame:
        return facts.standard_charges(self.base, self.hospital_ids)

    @cached_property
    def fct_standard_charges_semantic(self) -> DataFrame:
        return facts.semantic_charges(self.base, self.hospital_ids)

    @cached_property
    def dim_procedure_harmonized(self) -> DataFrame:
        return dims.dim_procedure_harmonized(
            self.fct_standard_charges_semantic, self.dim_procedure
        )

    @cached_property
    def fct_rates_comparable(self) -> DataFrame:
        return facts.comparable_rates(self.fct_standard_charges_semantic)

    @cached_property
    def fct_rates_comparable_harmonized(self) -> DataFrame:
        if self.families is None:
            return facts.harmonized_rates(self.fct_rates_comparable, self.payer_map, self.plan_map)
        return facts.harmonized_by_dimension(self.fct_rates_comparable, F.broadcast(self.families))

    @cached_property
    def families(self) -> DataFrame | None:
        """Families of every pair of names in the base, blanks for NULL; None unless the pairs are few.

        Names are brought into their match form once a pair then, not four regular expressions a rate. Only a base
        that was written is read again for it.
        """
        if not callable(self._base):
            return None
        pairs = self.base.select(text("payer_name").alias("payer_name"), text("plan_name").alias("plan_name"))
        found = written(dims.dim_payer_harmonized(pairs.distinct(), self.payer_map, self.plan_map))
        return found if is_small(found) else None

    @cached_property
    def fct_rates_comparable_rejects(self) -> DataFrame:
        return facts.newest_rejects(self.fct_rates_comparable)

    @cached_property
    def fct_billing_code_rejects(self) -> DataFrame:
        return facts.billing_code_rejects(self.fct_rates_comparable)

    @cached_property
    def agg_hospital_procedure_compare(self) -> DataFrame:
        return aggs.hospital_procedure_compare(self.fct_rates_comparable_harmonized)

    @cached_property
    def agg_payer_plan_compare(self) -> DataFrame:
        return aggs.payer_plan_compare(self.agg_hospital_procedure_compare)


# Marts worth writing once, each after the ones it reads.
TABLES = (
    "base", "hospital_lookup", "dim_hospital", "dim_payer", "dim_payer_harmonized",
    "dim_procedure", "dim_source_file", "fct_standard_charges", "fct_standard_charges_semantic",
    "dim_procedure_harmonized", "fct_rates_comparable_harmonized",
    "agg_hospital_procedure_compare",
)
# How the large tables are laid out, so that reports prune files and row groups.
SORTED_BY = {
    "fct_standard_charges": ("hospital_id", "billing_code", "payer_name"),
    "fct_standard_charges_semantic": ("hospital_id", "billing_code"),
    "fct_rates_comparable_harmonized": ("billing_code", "rate_category", "rate_unit"),
    "agg_hospital_procedure_compare": ("billing_code", "rate_category", "rate_unit"),
}


def materialize(marts: Marts, folder: str) -> Marts:
    """Write the marts under ``folder`` and return them as reads of what was written.

    Later marts and reports then start from tables whose sizes Spark knows, so it broadcasts a
    dimension only when its files are small, and a lost executor repeats a stage, not the chain.
    """
    spark = marts.csv_registry.sparkSession
    for name in TABLES:
        if name == "fct_rates_comparable_harmonized":
            frame = facts.harmonized_by_dimension(
                marts.fct_rates_comparable, marts.dim_payer_harmonized
            )
        else:
            frame = getattr(marts, name)
        if name in SORTED_BY:
            frame = frame.sortWithinPartitions(*SORTED_BY[name])
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
        setattr(marts, name, spark.read.parquet(f"{folder}/{name}"))
    # The comparable fact is the harmonised one without the families.
    wide = marts.fct_rates_comparable_harmonized
    marts.fct_rates_comparable = wide.drop("payer_family", "plan_family")
    return marts


def from_test_tables(spark: SparkSession, sf_dir: str) -> Marts:
    """Marts over the charge rows derived from the test tables; the base is written when a mart first reads it."""
    from ratelens.operators.staging import written_charge_base

    return Marts(
        lambda: written_charge_base(testdata.source(spark, sf_dir, "charges")),
        testdata.source(spark, sf_dir, "csv_registry"),
        testdata.source(spark, sf_dir, "json_registry"),
    )

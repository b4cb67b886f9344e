"""Invariants of the marts, exact medians against brute force, merges, exports and plans."""

import datetime
import io
import random
import statistics
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from ratelens.operators import aggs, analyst, dims, facts, quality, staging
from ratelens.operators.median import exact_median
from ratelens.plans import testdata
from ratelens.plans.marts import Marts, from_test_tables, materialize
from ratelens.schemas import COMPARABLE, COMPARE, HARMONIZED, SEMANTIC
from ratelens.sources import sinks


@pytest.fixture(scope="module")
def lazy(spark, sf_dir):
    return from_test_tables(spark, sf_dir)


@pytest.fixture(scope="module")
def marts(spark, sf_dir, tmp_path_factory):
    return materialize(from_test_tables(spark, sf_dir), str(tmp_path_factory.mktemp("marts")))


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_written_marts_equal_lazy_ones(lazy, marts):
    for name in ("fct_rates_comparable_harmonized", "agg_hospital_procedure_compare",
                 "dim_procedure_harmonized"):
        a, b = getattr(lazy, name), getattr(marts, name)
        b = b.select(*a.columns)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_grains(marts):
    semantic = marts.fct_standard_charges_semantic
    assert tuple(semantic.columns) == SEMANTIC
    assert tuple(marts.fct_rates_comparable.columns) == COMPARABLE
    assert tuple(marts.fct_rates_comparable_harmonized.columns) == HARMONIZED
    assert tuple(marts.agg_hospital_procedure_compare.columns) == COMPARE
    assert quality.unique(marts.base, "standard_charge_sk").isEmpty()
    assert quality.unique(semantic, "semantic_charge_sk").isEmpty()
    comparable = marts.fct_rates_comparable.count()
    assert marts.fct_rates_comparable_harmonized.count() == comparable == semantic.count()
    assert marts.dim_hospital.count() == marts.base.select("source_file_name").distinct().count()


def test_checks_pass(marts):
    for aggregate in (marts.agg_hospital_procedure_compare, marts.agg_payer_plan_compare):
        assert quality.other_category(aggregate).isEmpty()
        assert quality.not_empty(aggregate, "x").isEmpty()
    assert quality.numeric_prefixes(marts.dim_hospital).isEmpty()
    assert "facility_id" in quality.missing_contract_columns(marts.base)


def test_semantic_has_no_shuffle_of_its_own(marts):
    plan = plan_of(facts.semantic_charges(marts.base, marts.hospital_lookup))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    comparison = analyst.hospital_comparison(
        marts, billing_code="00010", payer_family="Aetna", rate_category="max", rate_unit="dollars")
    assert "PushedFilters: [" in plan_of(comparison) and "EqualTo(billing_code,00010)" in plan_of(comparison)


def test_dedupe_limits_rows_before_the_shuffle(spark, sf_dir):
    charges = testdata.source(spark, sf_dir, "charges")
    plan = plan_of(staging.charge_base(charges))
    assert plan.index("WindowGroupLimit") >= 0 and plan.count("WindowGroupLimit") >= 2


def test_hot_key_is_deduplicated(spark, sf_dir):
    """One charge delivered thousands of times next to ordinary ones."""
    charges = testdata.source(spark, sf_dir, "charges").orderBy("raw_rate_json").limit(50)
    one = charges.orderBy("raw_rate_json").limit(1)
    copies = one.crossJoin(spark.range(3000).withColumnRenamed("id", "n"))
    copies = copies.withColumn("run_id", F.format_string("retry-%05d", "n")).drop("n")
    base = staging.charge_base(charges, copies)
    assert base.count() == staging.charge_base(charges).count()
    assert base.filter("run_id = 'retry-02999'").count() == 1


def test_unregistered_file_is_its_own_hospital(spark, marts):
    empty = marts.csv_registry.limit(0)
    lookup = dims.hospital_lookup(empty, marts.json_registry.limit(0))
    dim = dims.dim_hospital(marts.base, lookup)
    fact = facts.standard_charges(marts.base, lookup)
    missing = quality.relationships(fact, "hospital_id", dim, "hospital_id")
    assert missing.isEmpty() and dim.count() == marts.dim_hospital.count()


def test_registry_with_many_runs_does_not_multiply(marts):
    twice = marts.csv_registry.unionByName(
        marts.csv_registry.withColumn("run_id", F.lit("9")))
    lookup = dims.hospital_lookup(twice, marts.json_registry)
    assert quality.unique(lookup, "source_file_name").isEmpty()


def test_exact_median_against_brute_force(spark):
    rng = random.Random(7)
    rows = [("hot", round(rng.choice([rng.uniform(-5, 5), rng.lognormvariate(3, 4)]), 2))
            for _ in range(4000)]
    rows += [(f"k{i % 40}", round(rng.uniform(0.01, 900), 2)) for i in range(900)]
    rows += [(None, 2.0), (None, 3.0), ("one", 4.0), ("zero", 0.0), ("null", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    got = {r.k: r["median"] for r in exact_median(df, ["k"], "v").collect()}
    assert got == {k: statistics.median(v) for k, v in groups.items()}
    everything = [v for vs in groups.values() for v in vs]
    assert exact_median(df, [], "v").first()[0] == statistics.median(everything)


def test_exact_and_sketched_aggregate_agree_on_the_rest(marts):
    sketched = marts.agg_hospital_procedure_compare.drop("approx_median_rate")
    exact = aggs.hospital_procedure_compare(
        marts.fct_rates_comparable_harmonized, exact=True).drop("approx_median_rate")
    assert sketched.exceptAll(exact).isEmpty() and exact.exceptAll(sketched).isEmpty()


def test_edited_seed_with_repeated_key(spark, marts):
    payers = spark.createDataFrame([("AETNA", "B"), ("AETNA", "A")], marts.payer_map.schema)
    rates = facts.harmonized_rates(marts.fct_rates_comparable, payers, marts.plan_map)
    assert rates.count() == marts.fct_rates_comparable.count()
    assert not rates.filter("payer_family = 'A'").isEmpty()


@pytest.mark.parametrize("whole_day", [False, True])
def test_incremental_merge_on_disk(spark, marts, tmp_path, whole_day):
    """Five old rows, or all rows of a day, come back under a new day."""
    path, work = str(tmp_path / "fact"), str(tmp_path / "work")
    cut = datetime.datetime(1997, 1, 1)
    old = marts.fct_standard_charges.filter(F.col("ingested_at") < cut)
    sinks.write_charges(old, path)
    first_day = old.agg(F.min("ingested_at")).first()[0]
    moved = marts.base.filter(F.col("ingested_at") < cut)
    if whole_day:
        moved = moved.filter(F.col("ingested_at") == first_day)
    else:
        moved = moved.orderBy("standard_charge_sk").limit(5)
    late = moved.withColumn("ingested_at", F.lit("1999-05-05").cast("timestamp_ntz"))
    base = marts.base.join(moved.select("standard_charge_sk"), "standard_charge_sk", "left_anti")
    sinks.merge_charges(path, base.unionByName(late), marts.hospital_lookup, work)
    table = spark.read.parquet(path)
    assert table.count() == marts.base.count()
    assert quality.unique(table, "standard_charge_sk").isEmpty()
    assert table.filter("ingest_day = date'1999-05-05'").count() == moved.count()
    assert whole_day == table.filter(F.col("ingest_day") == first_day.date()).isEmpty()


def test_exports_and_results(spark, marts, tmp_path):
    folder = str(tmp_path / "exports")
    counts = {r.relation: r.row_count for r in sinks.export_marts(marts, folder).collect()}
    assert counts["dim_hospital"] == marts.dim_hospital.count()
    schema = marts.dim_payer.schema
    assert sinks.read_export(spark, folder, "dim_payer", schema).count() == counts["dim_payer"]
    assert sinks.read_export(spark, folder, "absent", schema).isEmpty()
    only_csv = str(tmp_path / "csv")
    marts.dim_payer.write.option("header", True).csv(f"{only_csv}/dim_payer.csv")
    assert sinks.read_export(spark, only_csv, "dim_payer", schema).count() == counts["dim_payer"]
    for kind in ("csv", "json"):
        sinks.save_result(analyst.category_distribution(marts), f"{folder}/result_{kind}", kind)
    assert spark.read.json(f"{folder}/result_json").count() == 7


def test_required_filters(marts):
    assert analyst.get_rates(marts, billing_code="00010").isEmpty()
    assert analyst.get_rates(marts, use_comparable=False).isEmpty()
    assert analyst.search_procedures(marts, None, limit=3).count() == 3


def test_base_of_kinds(spark, sf_dir):
    with pytest.raises(ValueError):
        staging.base_of("other")
    charges = testdata.source(spark, sf_dir, "charges")
    assert staging.base_of("landing", landing=[charges]).count() == staging.charge_base(charges).count()
    assert isinstance(from_test_tables(spark, sf_dir), Marts)


@pytest.mark.parametrize("limit", [1, 100, 10_000_000])
def test_newest_rejects(marts, limit):
    rows = marts.fct_rates_comparable.filter("not is_comparable").collect()
    rows.sort(key=lambda r: r.semantic_charge_sk)
    rows.sort(key=lambda r: r.ingested_at, reverse=True)
    got = facts.newest_rejects(marts.fct_rates_comparable, limit).collect()
    assert {r.semantic_charge_sk for r in got} == {r.semantic_charge_sk for r in rows[:limit]}

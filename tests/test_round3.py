"""The base that is written once, merges by returning keys, medians by one shuffle: against plain versions."""

import datetime
import statistics

import pytest
from pyspark.sql import functions as F

from ratelens.operators import facts, median, quality, staging
from ratelens.operators.median import exact_summary
from ratelens.plans import testdata
from ratelens.plans.marts import Marts
from ratelens.schemas import STAGED_CHARGE


def charges(spark, rows):
    """Charges of (raw_rate_json, run_id, description, rate_amount); all else is the same or NULL."""
    df = spark.createDataFrame(rows, "raw_rate_json string, run_id string, description string, rate_amount double")
    known = {"source_file_name": "1_a_standardcharges.csv", "source_system": "csv_tall", "hospital_name": "H", "billing_code": "00010"}
    fixed = {c: F.lit(known.get(c)).cast("string") for c in STAGED_CHARGE if c not in df.columns}
    amounts = {c: F.lit(None).cast("double") for c in ("gross_charge", "discounted_cash", "minimum", "maximum")}
    return df.withColumns(fixed | amounts | {"ingested_at": F.lit(datetime.datetime(2024, 1, 1))})


ROWS = [("a", "1", "x", 1.0), ("a", "2", "y", 1.0), ("a", "2", "z", 1.0), ("b", None, None, None), ("b", None, "q", None),
        (None, "1", "x", 1.0), ("{}", "2", "x", 1.0), ("c", "1", "x", 3.0)]


def as_set(df):
    return sorted(map(repr, df.select("standard_charge_sk", *STAGED_CHARGE).collect()))


@pytest.mark.parametrize("rows", [ROWS, ROWS[3:4] + ROWS[-1:], []])
@pytest.mark.parametrize("limit", [0, 1, 100])
def test_written_base_is_the_base(spark, rows, limit, monkeypatch):
    monkeypatch.setattr(staging, "REPEATED_KEYS", limit)
    df = charges(spark, rows)
    assert as_set(staging.written_charge_base(df)) == as_set(staging.charge_base(df))


def test_only_repeated_keys_are_shuffled(spark):
    """Rows with a key of their own reach no exchange, whatever other rows do."""
    base = staging.written_charge_base(charges(spark, ROWS))
    plan = base._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") >= 1 and "LeftAnti" in plan and "LeftSemi" in plan
    alone = staging.written_charge_base(charges(spark, ROWS[-1:] + ROWS[3:4]))
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()


def test_base_is_built_once_and_only_if_read(spark, sf_dir):
    built = []

    def base():
        built.append(1)
        return staging.charge_base(charges(spark, ROWS))

    marts = Marts(base, testdata.source(spark, sf_dir, "csv_registry"), testdata.source(spark, sf_dir, "json_registry"))
    assert marts.hospital_lookup.count() > 0 and not built
    assert marts.dim_payer.count() == 0 and marts.fct_standard_charges.count() == 4 and built == [1]


@pytest.mark.parametrize("limit", [0, 1, 100])
def test_merge_replaces_returning_keys(spark, sf_dir, limit, monkeypatch):
    monkeypatch.setattr(facts, "REPEATED_KEYS", limit)
    lookup = Marts(None, testdata.source(spark, sf_dir, "csv_registry"), testdata.source(spark, sf_dir, "json_registry")).hospital_lookup
    old = facts.standard_charges(staging.charge_base(charges(spark, ROWS)), lookup)
    later = F.lit(datetime.datetime(2024, 2, 1))
    base = staging.charge_base(charges(spark, ROWS + [("d", "9", "new", 1.0)])).withColumns(
        {"ingested_at": F.when(F.col("raw_rate_json").isin("a", "b", "d"), later).otherwise(F.col("ingested_at")),
         "description": F.lit("again")})
    got = facts.merge_charges(old, base.unionByName(base), lookup)
    fresh = base.filter(F.col("ingested_at") == later)
    assert fresh.count() == 3 and got.count() == 5
    assert sorted(r.raw_rate_json or "" for r in got.filter("description = 'again'").collect()) == ["a", "b", "d"]
    assert as_set(facts.merge_charges(old, base.limit(0), lookup)) == as_set(old)


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_summary_in_one_shuffle(spark, hot):
    values = {("a", None): [3.0, 1.0, 2.0, 2.0], (None, "b"): [5.0], ("a", "b"): [1.0, 4.0, 2.0, -9.0, 0.0, 7.0], ("n", "n"): [None]}
    rows = [(*k, v, i) for k, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, j string, v double, t int")
    got = {(r.k, r.j): r for r in exact_summary(df, ["k", "j"], "v", latest="t", hot=hot).collect()}
    assert set(got) == set(values) - {("n", "n")}
    for key, r in got.items():
        vs = values[key]
        assert (r.row_count, r.lowest, r.highest, r.median, r.latest) == (len(vs), min(vs), max(vs), statistics.median(vs), len(vs) - 1)
    plan = median._ranked_summary(df.select("k", F.col("v").alias("_value"), F.col("t").alias("_latest")), ["k"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_check_run_sends_few_parents_to_the_rows(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string").repartition(3)
    parents = spark.createDataFrame([("a",), ("a",), (None,)], "p string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = quality.check_run(rows, "t", {}, references=[quality.Reference("k", parents, "p")])
        assert "SortMergeJoin" not in run._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {r.check_name: r.violations for r in run.collect()} == {"not_empty": 0, "relationships k": 1}


def test_families_are_looked_up_by_pair(spark, sf_dir):
    """Rates have the families that the maps give their names, blank ones and unknown ones included."""
    names = [("Aetna [123]", "PPO"), (None, None), ("", "choice."), ("Nobody & Co", None), (None, "PPO")]
    pairs = spark.createDataFrame([(f"r{i}", *n) for i, n in enumerate(names)], "raw_rate_json string, payer_name string, plan_name string")
    plain = charges(spark, [(f"r{i}", "1", "x", 2.0) for i in range(len(names))]).drop("payer_name", "plan_name")
    df = plain.join(pairs, "raw_rate_json")
    registries = testdata.source(spark, sf_dir, "csv_registry"), testdata.source(spark, sf_dir, "json_registry")
    plans = spark.createDataFrame([("", "", "NO PLAN"), ("Aetna", "PPO", "PPO")], "payer_family string, plan_name_norm string, plan_family string")
    marts = Marts(lambda: staging.written_charge_base(df), *registries, plan_map=plans)
    plan = marts.fct_rates_comparable_harmonized._jdf.queryExecution().optimizedPlan().toString()
    assert marts.families.count() == 5 and "strategy=broadcast" in plan
    direct = facts.harmonized_rates(marts.fct_rates_comparable, marts.payer_map, plans)
    assert sorted(map(repr, marts.fct_rates_comparable_harmonized.collect())) == sorted(map(repr, direct.collect()))
    assert direct.filter("plan_family = 'NO PLAN'").count() == 1

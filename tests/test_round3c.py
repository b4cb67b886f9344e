"""Deliveries that repeat most keys, against the plain base; the codes with the most rates."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.operators import aggs, analyst, staging
from ratelens.plans.marts import from_test_tables
from tests.test_round3 import ROWS, as_set, charges

MANY = [(str(i % 700), f"r{i % 9}" if i % 11 else None, f"d{i}", float(i % 3)) for i in range(3000)]


@pytest.mark.parametrize("rows", [ROWS, ROWS * 2, MANY, ROWS[3:4], []])
@pytest.mark.parametrize("limit", [0, 100_000])
def test_redelivered_base_is_the_base(spark, rows, limit, monkeypatch):
    monkeypatch.setattr(staging, "BITMAPS", limit)
    once = charges(spark, rows).repartition(3)
    again = once.withColumn("run_id", F.concat(F.lit("retry-"), "run_id"))
    assert as_set(staging.redelivered_base(once, again)) == as_set(staging.charge_base(once, again))


def test_load_time_comes_before_the_run(spark):
    once = charges(spark, [("a", "9", "x", 1.0), ("b", None, "x", 1.0), ("b", "1", "y", 1.0)])
    got = staging.redelivered_base(once, once.withColumn("run_id", F.lit(None).cast("string")))
    assert sorted((r.raw_rate_json, r.run_id, r.description) for r in got.collect()) == [("a", "9", "x"), ("b", "1", "y")]


def test_bitmaps_reach_every_row(spark):
    """Numbers of several partitions, and past the end of a bitmap."""
    ids = spark.range(0, 70_000, 1, 3).select(F.col("id").cast("string").alias("raw_rate_json"))
    rows = ids.withColumns({"run_id": F.lit("1"), "description": F.col("raw_rate_json"), "rate_amount": F.lit(1.0)})
    once = charges(spark, ROWS[:0]).unionByName(
        charges(spark, ROWS[:1]).limit(1).drop("raw_rate_json", "run_id", "description", "rate_amount").crossJoin(rows)
    )
    again = once.withColumn("run_id", F.lit("2"))
    got = staging.redelivered_base(once, again).groupBy("run_id").agg(F.count("*"), F.countDistinct("standard_charge_sk"))
    assert [tuple(r) for r in got.collect()] == [("2", 70_000, 70_000)]


def test_whole_rows_are_not_shuffled(spark):
    once = charges(spark, [("a", "1", "x", 1.0), ("b", "1", "y", 2.0)])
    base = staging.redelivered_base(once, once.withColumn("run_id", F.lit("2")))
    plan = base._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Window" not in plan
    assert isinstance(base.schema["standard_charge_sk"].dataType, T.StringType) and base.count() == 2


COMPARE = [("1", "CPT", "h1", 5), ("1", "CPT", "h1", 1), ("1", "CPT", "h2", 2), ("2", "CPT", "h1", 8), (None, "CPT", "h3", 9),
           ("3", None, "h1", 3), ("3", None, None, 3), ("4", "RC", "h1", 1), ("4", "RC", "h2", 1)]


class Few:
    """The two marts that the report reads."""

    def __init__(self, spark):
        codes = "billing_code string, billing_code_type string"
        self.agg_hospital_procedure_compare = spark.createDataFrame(COMPARE, f"{codes}, hospital_id string, row_count long")
        self.dim_procedure_harmonized = spark.createDataFrame([("1", "CPT", "one")], f"{codes}, canonical_description string")


@pytest.mark.parametrize("limit", [1, 3, 5, 10**7])
def test_top_codes_by_hand(spark, limit):
    every = [(None, "CPT", "", 9, 1), ("1", "CPT", "one", 8, 2), ("2", "CPT", "", 8, 1), ("3", "UNKNOWN", "", 6, 2), ("4", "RC", "", 2, 2)]
    assert [tuple(r) for r in analyst.top_codes(Few(spark), limit=limit).collect()] == every[:limit]
    assert analyst.top_codes(Few(spark), "RC", ["h2"]).first()["row_count"] == 1


def test_hospitals_are_told_apart_for_the_top_codes_only(spark, sf_dir):
    """The aggregate is shuffled once, and what meets the hospitals is cut to the top codes before."""
    marts = from_test_tables(spark, sf_dir)
    found = analyst.top_codes(marts, limit=3)
    assert found.count() == 3
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    shuffles = [line for line in final.splitlines() if "hashpartitioning(billing_code" in line and "payer_family" in line]
    assert sorted("ReusedExchange" in line for line in shuffles) == [False, True]


IDS = ["0f" * 16, "0F" * 16, "abc", "0abc", "", " ", "é", "h1", "00", "0", "\x01ab", None]


def test_ids_of_any_shape_are_kept_apart(spark):
    rows = spark.createDataFrame([(i,) for i in IDS * 2], "hospital_id string")
    assert [r[0] for r in rows.withColumn("hospital_id", aggs.packed("hospital_id")).select(aggs.unpacked("hospital_id")).collect()] == IDS * 2
    fixed = {c: F.lit(c) for c in ("billing_code", "billing_code_type", "payer_family", "plan_family", "rate_category", "rate_unit", "comparability_key")}
    rates = rows.withColumns(fixed | {"is_comparable": F.lit(True), "billing_code_is_valid": F.lit(True), "rate_amount": F.lit(2.0), "ingested_at": F.lit("d")})
    compare = aggs.hospital_procedure_compare(rates)
    assert sorted((str(r.hospital_id), r.row_count) for r in compare.collect()) == sorted((str(i), 2) for i in IDS)
    assert compare.schema["hospital_id"].dataType == T.StringType()
    hashed = rates.filter(F.col("hospital_id") == IDS[0]).select(F.octet_length(aggs.packed("hospital_id")))
    assert hashed.first()[0] == 17

"""Round 4: lookups by file are broadcast by rows, compared rates are shuffled as they are."""

import pytest
from pyspark.sql import functions as F

from ratelens.operators import aggs, analyst, quality
from ratelens.operators.median import by_size
from ratelens.plans.marts import from_test_tables
from ratelens.schemas import COMPARE_GRAIN

TEXTS = ["", "a", None, "\x01", "\x02", "\x02n", "\x02a\x01b", "a\x01", "é|"]


@pytest.fixture
def no_broadcast(spark):
    """As if every table were above Spark's limit."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rates_are_not_shuffled_by_file(spark, sf_dir, no_broadcast):
    marts = from_test_tables(spark, sf_dir)
    for frame in (marts.fct_standard_charges_semantic, marts.fct_standard_charges, marts.fct_rates_comparable_harmonized):
        plan = plan_of(frame)
        assert "SortMergeJoin" not in plan and "hashpartitioning(source_file_name" not in plan


def test_texts_of_any_shape_are_parted_as_joined(spark):
    rows = [(a, b, c) for a in TEXTS for b in TEXTS for c in TEXTS[:3]]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    back = df.select(aggs.joined("x", "y", "z").alias("t")).select(*aggs.parted("t", "x", "y", "z"))
    assert [tuple(r) for r in back.collect()] == rows
    assert df.select(aggs.joined("x", "y", "z").alias("t")).distinct().count() == len(rows)


def rates(spark):
    grain = [f"{c} string" for c in COMPARE_GRAIN]
    rows = [
        tuple((f"c{i % 3}" if c == "billing_code" else f"h{i % 2}" if c == "hospital_id" else [None, "x"][i % 5 == 0]) for c in COMPARE_GRAIN)
        + (float(i), f"d{i % 4}") for i in range(60)
    ]
    df = spark.createDataFrame(rows, ", ".join([*grain, "rate_amount double", "ingested_at string"]))
    return df.withColumns({"is_comparable": F.lit(True), "billing_code_is_valid": F.lit(True), "rate_category": F.lit(" Cash ")})


@pytest.mark.parametrize("exact", [False, True])
def test_large_and_usual_groups_agree(spark, exact):
    df = rates(spark)
    want = df.groupBy("hospital_id", "billing_code", "payer_family").agg(F.count("*").alias("n"), F.max("rate_amount").alias("m"))
    want = sorted(map(str, want.collect()))
    for hot in (1, 10**9):
        got = aggs.hospital_procedure_compare(df, exact=exact, hot=hot)
        assert sorted(map(str, got.selectExpr("hospital_id", "billing_code", "payer_family", "row_count as n", "max_rate as m").collect())) == want
        assert {r[0] for r in got.select("rate_category").collect()} == {"cash"}


def test_large_groups_are_told_apart(spark):
    df = spark.createDataFrame([(i % 10, i) for i in range(100)] + [(99, i) for i in range(50)], "k long, v long")
    usual, large = by_size(df, ["k"], hot=50)
    assert {r.k for r in large.collect()} == {99} and usual.count() == 100


def test_compared_rates_are_shuffled_without_sketches(spark, sf_dir):
    marts = from_test_tables(spark, sf_dir)
    plan = plan_of(marts.agg_hospital_procedure_compare)
    dealt = [line for line in plan.splitlines() if "hashpartitioning(billing_code" in line and "REPARTITION" in line and "_tail" not in line]
    assert len(dealt) == 1  # of whole rates; the aggregation of the usual ones needs none of its own


def test_coverage_by_hand(spark, sf_dir):
    marts = from_test_tables(spark, sf_dir)
    got = {r.hospital_id: r for r in analyst.coverage_matrix(marts).collect()}
    rows = marts.agg_payer_plan_compare.select("hospital_id", "billing_code", "payer_family", "plan_family", "row_count").collect()
    assert set(got) == {r.hospital_id for r in rows}
    for h, r in got.items():
        own = [x for x in rows if x.hospital_id == h]
        assert r.total_comparable_rows == sum(x.row_count for x in own)
        for c, n in (("billing_code", r.distinct_billing_codes), ("payer_family", r.distinct_payer_family), ("plan_family", r.distinct_plan_family)):
            assert n == len({x[c] for x in own} - {None})


@pytest.mark.parametrize("hot", [1, 10**9])
def test_mixed_attributes_by_hand(spark, hot):
    rows = [("a", "1", "x", "u"), ("a", "1", "y", "u"), ("a", "2", "x", "u"), ("a", "2", "x", "u"), (None, "1", None, "u"), (None, "1", "", "v")]
    df = spark.createDataFrame(rows, "k string, j string, p string, q string")
    got = quality.mixed_attributes(df, ["k", "j"], ["p", "q"], hot=hot)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == ["('a', '1', 2, 1)", "(None, '1', 1, 2)"]
    plan = plan_of(quality.mixed_attributes(df, ["k", "j"], ["p", "q"], hot=hot))
    assert "Expand" not in plan and plan.count("REPARTITION_BY_COL") == 1

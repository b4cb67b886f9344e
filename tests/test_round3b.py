"""Costly rows are spread before they are read, members of an item are read once, lines of CSV records are scanned once."""

import pytest
from ratelens.operators import silver
from ratelens.plans import testdata
from ratelens.plans.queries import QUERIES
from ratelens.sources import csv_files
from ratelens.sources.csv_records import records


@pytest.mark.parametrize("name", testdata.COSTLY)
def test_costly_rows_are_spread_after_the_join(spark, sf_dir, name):
    plan = testdata.bronze(spark, sf_dir, name)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    spread = [i for i, line in enumerate(lines) if "RepartitionByExpression [l_orderkey" in line]
    assert spread and spread[0] < min(i for i, line in enumerate(lines) if "Join" in line)


PAYLOADS = [
    '{"standardCharges":[7,"x",{"code":"A","negotiated_rate":0,"gross_charge":null,"cash_discount":""}]}',
    '{"standardCharges":[{"code_information":[{"code":"","cpt":"B"}],"standard_charges":[3,{"minimum":"-","maximum":2,'
    '"payers_information":[4,{"payer":0,"payer_name":"P","standard_charge_dollar":0,"standard_charge":"$1"}]}]}]}',
    "[]",
]


def test_members_of_an_item_are_read_once(spark):
    rows = spark.createDataFrame([(p,) for p in PAYLOADS], "payload_json string").selectExpr(
        "'1_a.json' as source_path", "'json' as source_format", "'2024-01-01' as ingest_date", "'json' as _source_system", "payload_json")
    rates = silver.payload_rates(rows)
    plan = rates._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Filter" in line and "try_variant_get" in line]
    got = rates.select("billing_code", "payer_name", "rate_type", "rate_amount", "reason_code").collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        ("A", None, "NEGOTIATED", 0.0, None), ("B", None, "MAXIMUM", 2.0, None), ("B", "P", "NEGOTIATED", 1.0, None),
        (None, None, None, None, "JSON_UNSUPPORTED_SHAPE")], key=str)


def test_lines_of_records_are_scanned_once(spark, sf_dir):
    """What the numbering of records does several times over reads tables, no plan that starts from the files again."""
    raw = testdata.csv_lines(spark, sf_dir)
    got = records(raw, csv_files.landing_profile(raw), csv_files.DELIMITERS)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Relation ") <= 6
    # Every line item is a record of two lines, below a header of three.
    items = testdata.table(spark, sf_dir, "lineitem")
    assert got.count() == items.count() + 3 * items.select("l_suppkey").distinct().count()


def test_union_of_sources_shuffles_hashes_of_keys(spark, sf_dir):
    """Rows of the union stay where they are but for those with a repeated key, of which these tables have none."""
    plan = QUERIES["t09_union_base"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan

"""Registered queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
# One of each kind here; ``tools/check_oracle.py`` runs them all.
CHECKED = [
    "m01_dim_hospital", "m04_dim_payer_harmonized", "m06_dim_procedure_harmonized",
    "m09_incremental_merge", "m14_lake_semantic", "m16_harmonized", "m19_agg_compare",
    "t09_union_base", "t12_dedupe", "v05_payload_rates", "v08_tabular_rates",
    "v13_quality_metrics", "g03_funnel", "a05_payer_rollup", "a10_hospital_rates",
    "a28_search_kpis", "a30_histogram", "a31_measures", "a32_negotiated_cash_delta",
    "q06_code_formats", "i02_not_loaded", "i19_extract_records",
    "q00_check_run_delivered", "i21_capped", "m09_returning_keys",
]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", CHECKED)
def test_query(spark, con, sf_dir, name):
    good, message = compare(spark, con, sf_dir, name, QUERIES[name], ORACLE[name])
    assert good, message


def test_every_oracle_has_its_query():
    assert set(ORACLE) <= set(QUERIES)


def test_every_oracle_runs(con):
    for name, sql in ORACLE.items():
        assert con.sql(sql).columns, name


def test_entry(spark):
    assert entry.entry(spark).count() > 0

"""Amounts and keys as files write them, first lines, and reruns that have fewer rows."""

import datetime
import json
from collections import Counter

from pyspark.sql import functions as F

from ratelens.operators import facts, quality, silver
from ratelens.schemas import STAGED_CHARGE
from ratelens.sources import files, json_files, sinks


def payload(amounts):
    item = {"code": "X9", "negotiated_rate": amounts[0], "gross_charge": amounts[1]}
    charge = {"minimum": amounts[2], "payers_information": [{"negotiated_rate": 0, "standard_charge": amounts[3]}]}
    nested = {"code_information": [{"code": "N1"}], "standard_charges": [charge]}
    return '{"standardCharges": [%s, %s]}' % (json.dumps(item), json.dumps(nested))


def test_amounts_with_exponents(spark):
    text = payload(["$1,200.50", 1, 2, 3]).replace('"gross_charge": 1', '"gross_charge": 1.5e7')
    text = text.replace('"minimum": 2', '"minimum": 1e-05').replace('"standard_charge": 3', '"standard_charge": 2.5E3')
    bronze = spark.createDataFrame([("f.json", text)], "source_path string, payload_json string").selectExpr(
        "*", "'json' as source_format", "'2024-01-01' as ingest_date", "'json' as _source_system"
    )
    got = {(r.billing_code, r.rate_type): r.rate_amount for r in silver.candidate_rates(bronze).collect()}
    assert got == {
        ("X9", "NEGOTIATED"): 1200.5, ("X9", "GROSS"): 1.5e7,
        ("N1", "MINIMUM"): 1e-05, ("N1", "NEGOTIATED"): 2500.0,
    }


def test_flattened_keeps_keys_and_values(spark):
    texts = ['{"AVOIDABLE": "x", "Code": "1", "n": null}', '{"code": "2", "OBJECT": {"VOID": 3, "a: VOID": "y"}}']
    flat = json_files.flattened(spark.createDataFrame([(t,) for t in texts], "record_json string"))
    rows = [{k.lower(): v for k, v in r.asDict().items()} for r in flat.collect()]
    assert {r["code"] for r in rows} == {"1", "2"}
    assert {r["avoidable"] for r in rows} == {"x", None}
    assert {r["object.void"] for r in rows} == {"3", None}
    assert {r["object.a: void"] for r in rows} == {"y", None}


def test_first_lines_are_limited_before_the_shuffle(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(f"line {i}" for i in range(40)))
    first = files.first_lines(files.lines(spark, str(tmp_path), "*.csv"), 3)
    assert sorted((r.line_no, r.bytes) for r in first.collect()) == [(i, f"line {i}") for i in range(3)]
    plan = spark.sql("explain formatted select * from {f}", f=first).first()[0]
    assert "WindowGroupLimit" in plan


def test_a_rerun_without_rows_empties_its_day(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01")], "code string, ingest_date string")
    sinks.overwrite_day(rows, path, "ingest_date", "2024-01-01")
    sinks.overwrite_day(rows, path, "ingest_date", "2024-01-02")
    sinks.overwrite_day(rows.limit(0), path, "ingest_date", "2024-01-01")
    left = spark.read.parquet(path).select(F.col("ingest_date").cast("string")).collect()
    assert [r[0] for r in left] == ["2024-01-02"] * 2


def test_profiles_cover_every_line_and_level(spark):
    deep = json.dumps({"a": [{"b": 1}]})
    for _ in range(10):
        deep = '{"n": [%s]}' % deep
    docs = spark.createDataFrame([(deep,)], "document string")
    paths = {r.path for r in json_files.structure_profile(docs).collect()}
    assert any(p.endswith("a.item") for p in paths) and len(paths) == 11
    lines = spark.range(2500).select(F.format_string('{"k%d": 1}', "id").alias("line"))
    row = json_files.key_profile(lines).first()
    assert row.json_lines == 2500 and len(row.sample_keys.split(",")) == 2500


def test_check_run_counts_over_one_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame(
        [(1, "a", "x"), (1, None, "y"), (2, "b", "x"), (None, "z", None), (None, "a", "x")], "k int, c string, u string"
    ).write.parquet(path)
    rows, parent = spark.read.parquet(path), spark.createDataFrame([("x",), ("x",), (None,)], "p string")
    run = quality.check_run(
        rows, "t", {**quality.no_nulls("k", "c"), **quality.only_values("c", ["a", "b"])}, unique=["k", "u"],
        references=[quality.Reference("u", parent, "p")])
    assert {r.check_name: r.violations for r in run.collect()} == {
        "not_empty": 0, "not_null k": 2, "not_null c": 1, "accepted_values c": 1, "relationships u": 1,
        "unique k": 1, "unique u": 1,
    }
    assert run._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    empty = quality.check_run(rows.limit(0), "t", quality.no_nulls("k"), unique=["u"])
    assert {r.check_name: r.violations for r in empty.collect()} == {"not_empty": 1, "not_null k": 0, "unique u": 0}


def test_capped_rows_are_the_same_each_time(spark, monkeypatch):
    monkeypatch.setattr(json_files, "COPIES", 7)
    rows = spark.range(60).selectExpr("cast(id as string) as a", "cast(null as string) as b").unionByName(
        spark.range(100).selectExpr("'same' as a", "'row' as b"))
    whole = sorted(rows.collect(), key=str)
    assert sorted(json_files.capped(rows, 0).collect(), key=str) == whole
    before = []
    for n in (1, 50, 130, 160, 500):
        kept = sorted(json_files.capped(rows, n).collect(), key=str)
        assert len(kept) == min(n, 160)
        assert kept == sorted(json_files.capped(rows.repartition(5), n).collect(), key=str)
        assert not Counter(before) - Counter(kept) and not Counter(kept) - Counter(whole)
        before = kept


def test_older_rows_are_left_out_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "base")
    columns = [f"cast(null as string) as {c}" for c in STAGED_CHARGE if c != "ingested_at"]
    spark.range(3).selectExpr(
        "cast(id as string) as standard_charge_sk", "timestamp_seconds(id) as ingested_at", *columns).write.parquet(path)
    hospitals = spark.createDataFrame([], "source_file_name string, hospital_id string")
    newest = datetime.datetime(1970, 1, 1, 0, 0, 1)
    fresh = facts.newer_charges(spark.read.parquet(path), newest, hospitals)
    assert [r.standard_charge_sk for r in fresh.collect()] == ["2"]
    assert "GreaterThan(ingested_at" in fresh._jdf.queryExecution().executedPlan().toString()


def test_a_document_is_read_once_per_value(spark):
    """What a lambda names several times is computed once: the plan does not repeat the look-ups."""
    from ratelens.operators import silver

    bronze = spark.createDataFrame(
        [("a.json", "json", "2024-01-01", '{"standardCharges":[]}')],
        "source_path string, source_format string, ingest_date string, payload_json string",
    )
    plan = silver.candidate_rates(bronze)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") <= 2 and plan.count("variant_get(") <= 40


def test_lake_rows_are_parsed_once(spark, sf_dir):
    """Dimension and fact read the written base; neither parses a document again."""
    from ratelens.plans.queries import QUERIES

    plan = QUERIES["m10_lake_standard_charges"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json(" not in plan


def test_depths_are_scanned_once(spark):
    """Every branch of the cut reads the written scan."""
    from ratelens.sources import json_elements

    raw = spark.createDataFrame(
        [("a.json", 0, 0, '{"k":[{"x":1', 23), ("a.json", 0, 1, ',{"x":2', 23), ("a.json", 0, 2, "]", 23)],
        "source_path string, block long, position long, bytes string, file_size_bytes long",
    )
    cut = json_elements.elements(raw, "k")
    assert "from_in" not in cut._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.element for r in cut.collect()) == ['{"x":1}', '{"x":2}']

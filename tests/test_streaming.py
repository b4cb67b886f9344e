"""Incremental load of NDJSON files."""

from ratelens.streaming.bronze_stream import load_available


def test_files_are_loaded_once(spark, tmp_path):
    drop, lake, marks = tmp_path / "drop", str(tmp_path / "lake"), str(tmp_path / "marks")
    drop.mkdir()
    (drop / "a.json").write_text('{"code": "99213", "negotiated_rate": "5"}\n{"code": ""}\n')
    load_available(spark, str(drop), lake, "2024-01-01", marks).awaitTermination()
    (drop / "b.json").write_text('{"billing_code": "99214", "gross_charge": "7", "payer": "P"}\n')
    for _ in range(2):
        load_available(spark, str(drop), lake, "2024-01-01", marks).awaitTermination()
    good = spark.read.parquet(f"{lake}/stream/standard_charges")
    rows = sorted((r.billing_code, r.rate_type, r.rate_amount, r.payer_name) for r in good.collect())
    assert rows == [("99213", "NEGOTIATED", 5.0, None), ("99214", "GROSS", 7.0, "P")]
    bad = spark.read.parquet(f"{lake}/stream/quarantine")
    assert [r.reason_code for r in bad.collect()] == ["MISSING_RATE"]

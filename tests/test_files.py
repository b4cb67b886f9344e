"""Ingest of small files made here: landing tables, Bronze and Silver."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ratelens.operators import silver
from ratelens.plans import lake
from ratelens.sources import commits, csv_files, csv_records, files, json_elements, json_files, sinks

PREAMBLE_CSV = """Fixture of the ingest tests,,,,,,
two lines come first,,,,,,
billing_code,description,payer_name,plan_name,negotiated_rate,gross_charge,discounted_cash_price
71046,"Chest film, two views",Larkspur Mutual,Silver,61.40,118.75,97.10
73562,Knee film,Larkspur Mutual,Silver,,143.20,
73562,Knee film,Tamarind Health,Basic,88.15,143.20,101.05
80048,"Panel, basic",Tamarind Health,Basic,19.90,52.60,
"""
PIPE_HEADERS = (
    "code|1,description,payer_name,plan_name,standard_charge|negotiated_dollar,"
    "standard_charge|gross,standard_charge|discounted_cash"
)
DOCUMENT = {
    "standardCharges": [
        {
            "description": "Panel",
            "code_information": [{"type": "CPT", "code": "80048"}],
            "standard_charges": [
                {
                    "maximum": 60, "minimum": "12.50", "gross_charge": 52.6,
                    "payers_information": [{"plan_name": "Basic", "payer_name": "Tamarind", "standard_charge_dollar": "19.90"}],
                }
            ],
        },
        {
            "code_information": [{"code": "73562", "type": "CPT"}],
            "standard_charges": [
                {"payers_information": [{"payer_name": "Larkspur", "plan_name": "Gold", "negotiated_rate": "77.25"}],
                 "gross_charge": "143.20"},
                {"maximum": "150.00", "payers_information": []},
            ],
        },
    ]
}
SERVICES = {
    "standard_charge_information": [
        {
            "description": " Visit ",
            "code_information": [{"code": "85025", "type": "CPT"}],
            "standard_charges": [
                {
                    "setting": "outpatient", "gross_charge": 200,
                    "payers_information": [
                        {"payer_name": "A", "plan_name": "P", "methodology": "fee",
                         "estimated_amount": 150.5},
                        {"payer_name": "B", "estimated_amount": "x"},
                        "not an object",
                    ],
                },
                {"setting": "inpatient"},
            ],
        }
    ]
}


@pytest.fixture()
def drop(tmp_path):
    root = tmp_path / "drop"
    (root / "sub").mkdir(parents=True)
    (root / "tall.csv").write_text(PREAMBLE_CSV)
    lines = PREAMBLE_CSV.splitlines()
    (root / "sub" / "pipe.csv").write_text("\n".join([*lines[:2], PIPE_HEADERS, *lines[3:]]))
    (root / "none.csv").write_text("hello,world\n1,2\n")
    (root / "nested.json").write_text(json.dumps(DOCUMENT, indent=1))
    flat = [("36415", 6.05), ("85025", 14.3), ("85027", 11.75)]
    (root / "flat.json").write_text(
        json.dumps([{"plan": "Open", "payer": "Juniper", "more": [1, {"b": 2}], "billing_code": c, "negotiated_rate": r}
                    for c, r in flat])
    )
    (root / "rows.json").write_text(
        '{"code": "J1234", "gross_charge": "12.50"}\n\n{"code": "", "gross_charge": "9"}\n'
    )
    (root / "broken.json").write_text('{"a": ')
    return root


def collect(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_listing_and_hashes(spark, drop):
    (drop / "notes.txt").write_text("x")
    listed = collect(files.list_files(spark, str(drop)), "source_file_name", "source_format")
    assert ("notes.txt", None) in listed and ("pipe.csv", "csv") in listed
    assert len(listed) == 8
    import hashlib

    hashed = {r.source_file_name: r.file_hash for r in files.hashed_files(spark, str(drop)).collect()}
    assert hashed["rows.json"] == hashlib.sha256((drop / "rows.json").read_bytes()).hexdigest()


def test_hash_of_files_too_large_for_a_value(spark, drop):
    texts = {"a.csv": "x\ny\nz\n" * 900, "b.csv": "x\ny\nz\n" * 900, "c.csv": "x\nz\ny\n" * 900, "d.csv": "x\ny\nz\n" * 899 + "x\ny\nz"}
    for name, text in texts.items():
        (drop / name).write_text(text)

    def hashes():
        return {r.source_file_name: r.file_hash for r in files.hashed_files(spark, str(drop), whole=2000).collect()}

    once = hashes()
    assert set(texts) < set(once) and {len(h) for h in once.values()} == {64}
    assert once["a.csv"] == once["b.csv"] and len({once[n] for n in "a.csv c.csv d.csv".split()}) == 3
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert hashes() == once
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_header_report(spark, drop):
    report = csv_files.header_report(files.lines(spark, str(drop), "*.csv"))
    found = {r.source_path.rsplit("/", 1)[1]: r for r in report.collect()}
    assert (found["tall.csv"].header_row, found["tall.csv"].header_score) == (2, 8)
    assert found["tall.csv"].looks_like_charge_table
    assert found["none.csv"].header_row == 0 and not found["none.csv"].looks_like_charge_table
    assert found["pipe.csv"].columns[5] == "standard_charge|gross"


def test_line_numbers_over_splits(spark, drop):
    (drop / "long.csv").write_text("".join(f"{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        raw = files.lines(spark, str(drop), "long.csv")
        assert raw.select("block").distinct().count() > 3
        numbered = files.with_line_numbers(raw)
        assert numbered.filter(F.col("bytes").cast("int") != F.col("line_no")).isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


EXPECTED_CSV = [
    ("71046", "CASH", 97.1, "Larkspur Mutual"), ("71046", "GROSS", 118.75, "Larkspur Mutual"),
    ("71046", "NEGOTIATED", 61.4, "Larkspur Mutual"), ("73562", "GROSS", 143.2, "Larkspur Mutual"),
    ("73562", "CASH", 101.05, "Tamarind Health"), ("73562", "GROSS", 143.2, "Tamarind Health"),
    ("73562", "NEGOTIATED", 88.15, "Tamarind Health"), ("80048", "GROSS", 52.6, "Tamarind Health"),
    ("80048", "NEGOTIATED", 19.9, "Tamarind Health"),
]
EXPECTED_NESTED = [
    ("80048", "GROSS_CHARGE", 52.6, None), ("80048", "MAXIMUM", 60.0, None), ("80048", "MINIMUM", 12.5, None),
    ("80048", "NEGOTIATED", 19.9, "Tamarind"), ("73562", "GROSS_CHARGE", 143.2, None),
    ("73562", "NEGOTIATED", 77.25, "Larkspur"), ("73562", "MAXIMUM", 150.0, None),
]


def test_bronze_and_silver(spark, drop, tmp_path):
    target = str(tmp_path / "lake")
    first = lake.run_bronze(spark, str(drop), target, "2024-01-02").first()
    assert (first.ingested, first.skipped, first.failed) == (6, 0, 1)
    again = lake.run_bronze(spark, str(drop), target, "2024-01-02").first()
    assert (again.ingested, again.skipped, again.failed) == (0, 6, 1)
    forced = lake.run_bronze(spark, str(drop), target, "2024-01-02", forced=["pt_csv"]).first()
    assert (forced.ingested, forced.skipped) == (3, 3)

    metrics = lake.run_silver(spark, target, "2024-01-02").first()
    rows = sinks.read_silver(spark, target)

    def of(name):
        mine = rows.filter(F.col("source_file_name").endswith(name))
        got = mine.select("billing_code", "rate_type", "rate_amount", "payer_name").collect()
        return sorted(map(tuple, got), key=str)

    assert of("/tall.csv") == sorted(EXPECTED_CSV, key=str)
    assert of("/pipe.csv") == sorted(EXPECTED_CSV, key=str)
    assert of("nested.json") == sorted(EXPECTED_NESTED, key=str)
    assert of("flat.json") == [("36415", "NEGOTIATED", 6.05, "Juniper"), ("85025", "NEGOTIATED", 14.3, "Juniper"),
                               ("85027", "NEGOTIATED", 11.75, "Juniper")]
    assert of("rows.json") == [("J1234", "GROSS", 12.5, None)]
    bad = spark.read.parquet(f"{target}/silver/quarantine")
    reasons = {(r.source_file_name.rsplit("/", 1)[1], r.reason_code) for r in bad.collect()}
    assert reasons == {("none.csv", "MISSING_RATE"), ("rows.json", "MISSING_CODE")}
    assert metrics.total_rows == metrics.good_rows + metrics.quarantine_rows == 31
    with pytest.raises(ValueError):
        lake.run_silver(spark, target, "2024-01-02", threshold=0.01)


def test_quoted_line_breaks_are_read(spark, tmp_path):
    root, target = tmp_path / "drop", str(tmp_path / "lake")
    root.mkdir()
    (root / "good.csv").write_text(PREAMBLE_CSV)
    (root / "open.csv").write_text(PREAMBLE_CSV + '1,"two\nlines",1,1,1,A,B\n')
    summary = lake.run_bronze(spark, str(root), target, "2024-01-02").first()
    assert (summary.ingested, summary.failed) == (2, 0)
    rows = sinks.read_bronze(spark, target, "2024-01-02")
    assert rows.count() == 9 and rows.filter("description = 'two\\nlines'").count() == 1


def plain_records(text, mark):
    """Records of a text, read character by character."""
    out, lines = [], text.split("\n")
    k = 0
    while k < len(lines):
        record, inside, n = "", False, 0
        while True:
            line, at = lines[k + n], 0
            fresh = not inside
            while at < len(line):
                if inside:
                    if line[at : at + 2] == '""':
                        at += 1
                    elif line[at] == '"':
                        inside = False
                    fresh = False
                else:
                    inside = fresh and line[at] == '"'
                    fresh = line[at] == mark
                at += 1
            record = f"{record}\n{line}" if n else line
            n += 1
            if not inside:
                out.append(record)
                break
            if k + n == len(lines):  # never closed
                return out + lines[k:]
        k += n
    return out


def test_records_over_lines_and_blocks(spark):
    """Every cut of a text into blocks gives the records that a reader of the whole text finds."""
    rng = random.Random(4)
    pieces = ['"', '"', '""', ",", "a", "b c", "\n", "\n", '",', ',"', "|"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 60))) for _ in range(150)]
    texts += ['5" catheter,1\n2,"x\ny"\n3', 'a,"b""\n""c",d\ne', '"never\nclosed,1\n2', '"a"b,"c\nd"e\nf', '""\n"\n"', '"']
    rows = []
    for k, text in enumerate(texts):
        block, position = 0, 0
        for line in text.split("\n"):
            rows.append((f"f{k}", block, block * 1000 + position, line))
            position += 1
            if rng.random() < 0.3:
                block, position = block + 1, 0
    raw = spark.createDataFrame(rows, "source_path string, block long, position long, bytes string")
    for mark in (",", "|"):
        profile = spark.createDataFrame([(f"f{k}", mark) for k in range(len(texts))], "source_path string, delimiter string")
        got = {}
        for r in csv_records.records(raw, profile, csv_files.DELIMITERS).orderBy("line_no").collect():
            got.setdefault(r.source_path, []).append((r.line_no, r.bytes))
        for k, text in enumerate(texts):
            assert got[f"f{k}"] == list(enumerate(plain_records(text, mark))), text


def json_value(rng, depth=0):
    texts = ["", "a } b", "]}", '"', "\\", '\\"}', "é{[", "standard_charge_information", '"k": [{']
    kind = rng.choice(["text", "text", "number", "null", "object", "array"] if depth < 3 else ["text", "number"])
    if kind == "object":
        return {rng.choice("abck") + str(i): json_value(rng, depth + 1) for i in range(rng.randrange(4))}
    if kind == "array":
        return [json_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {"text": rng.choice(texts), "number": rng.choice([0, -1.5e-7, 12]), "null": None}[kind]


@pytest.mark.parametrize("size", ["700", "134217728"])
def test_elements_of_documents_over_splits(spark, tmp_path, size):
    """Objects of an array, by key and at the top, are those of the whole parse; a document spans several tasks."""
    rng = random.Random(5)
    documents = {}
    for i in range(12):
        array = [{"n": j, "v": json_value(rng)} for j in range(rng.randrange(1, 90))]
        if i % 4 == 3:
            array = [x for pair in zip(array, [1, "a } b" if i == 3 else "b]", None] * 30) for x in pair]
        holder = {"x": json_value(rng), "d": {"k": [{"no": 1}]}, "k": array, "z": json_value(rng)}
        documents[f"k{i}.json"], documents[f"a{i}.json"] = holder, array
    for name, value in documents.items():
        (tmp_path / name).write_text(json.dumps(value, indent=rng.choice([None, 1]), ensure_ascii=False) + rng.choice(["", "\n"]))
    (tmp_path / "open.json").write_text('[{"a": 1}, {"b": "}')
    (tmp_path / "more.json").write_text('[{"a": 1}] x')
    (tmp_path / "none.json").write_text('{"kk": [{"k": [{"a": 1}]}]}')
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        texts = json_elements.chunks(spark, str(tmp_path))
        if size == "700":
            assert texts.groupBy("source_path").agg(F.count_distinct("block").alias("n")).filter("n > 2").count() > 2
        for key, mark in (("k", "k"), (None, "a")):
            got = {}
            cut = json_elements.elements(texts, key)
            for r in cut.orderBy("place").collect():
                got.setdefault(r.source_path.rsplit("/", 1)[1], []).append(r.element)
            whole = {r.source_path.rsplit("/", 1)[1]: (r.whole, r.broken) for r in json_elements.outcomes(cut).collect()}
            for name, value in documents.items():
                if name[0] != mark:
                    continue
                array = value["k"] if key else value
                if key is None and any(not isinstance(x, dict) for x in array):
                    assert name not in got or whole[name] == (True, False)
                elif any(isinstance(x, str) and "}" in x for x in array):
                    assert whole[name] in ((True, False), (False, False))
                else:
                    assert [json.loads(e) for e in got[name]] == [x for x in array if isinstance(x, dict)], name
                    assert whole[name] == (False, False)
            assert got["open.json"] == [None] and whole["open.json"] == (False, True)
            assert "none.json" not in got and got.get("more.json") == (None if key else [None])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_payload_shapes(spark):
    docs = spark.createDataFrame(
        [("a", "[]"), ("b", "5"), ("c", '[1, {"x": 2}]'), ("d", '[{"x": 1}, {"x": 2}]'), ("e", "{")],
        "source_path string, document string",
    )
    rows = json_files.document_records(docs)
    got = {}
    for r in rows.collect():
        got.setdefault(r.source_path, []).append((r.record_json, r.payload_json, r.error_message))
    assert got["a"] == [(None, "[]", None)] and got["b"] == [(None, "5", None)]
    assert got["c"] == [(None, '[1,{"x":2}]', None)]
    assert sorted(got["d"]) == [('{"x":1}', None, None), ('{"x":2}', None, None)]
    assert got["e"] == [(None, None, "invalid JSON")]
    flat = json_files.flattened(
        spark.createDataFrame([('{"a": {"b": 1}, "c": "x"}',), ('{"d": 2}',)], "record_json string")
    )
    assert sorted(flat.columns) == ["a.b", "c", "d"]


def test_unsupported_and_alias_payloads(spark):
    payloads = [
        '{"rates": []}', '{"standardCharges": null}', '{"standardcharges": []}',
        '{"standardCharges": [{"code_information": {"billingCode": {"value": "X1"}},'
        ' "standard_charges": [{"maximum": 4}, 7]}]}',
        '{"standardCharges": [{"code": 5, "negotiated_rate": 0, "payer_name": ""}]}',
    ]
    bronze = spark.createDataFrame(
        [(f"f{i}.json", p) for i, p in enumerate(payloads)], "source_path string, payload_json string"
    ).selectExpr("*", "'json' as source_format", "'2024-01-01' as ingest_date", "'json' as _source_system")
    got = {}
    for r in silver.candidate_rates(bronze).collect():
        got.setdefault(r.source_file_name, []).append(
            (r.billing_code, r.rate_type, r.rate_amount, r.reason_code))
    assert got["f0.json"] == got["f1.json"] == [(None, None, None, "JSON_UNSUPPORTED_SHAPE")]
    assert "f2.json" not in got
    assert got["f3.json"] == [("X1", "MAXIMUM", 4.0, None)]
    assert got["f4.json"] == [("5", "NEGOTIATED", 0.0, None)]


def landing_csv(width, delimiter=","):
    heads = ["code", "code_type", "description", "payer_name", "negotiated_rate"]
    heads += [f"extra_{i}" for i in range(width - len(heads))]
    labels = ["hospital_name", "", "state", "license", "version"]
    values = ["General", "x", "MO", "1", "2.0"]
    row = ["85025", "CPT", f'"A{delimiter} ""quoted"" b"', "Aetna", "12.5"]
    row += ["" for _ in heads[5:]]
    return "\n".join(delimiter.join(r) for r in (labels, values, heads, row, row)) + "\n"


def test_landing(spark, tmp_path):
    root = tmp_path / "drop"
    root.mkdir()
    (root / "tall.csv").write_text("﻿" + landing_csv(37))
    (root / "wide.csv").write_text(landing_csv(38, "|"))
    (root / "latin.csv").write_bytes(landing_csv(6).replace("General", "Génér").encode("latin-1"))
    (root / "services.json").write_text(json.dumps(SERVICES))
    (root / "lines.json").write_text(
        '{"service_code": "1", "price": "2.5", "desc": "d"}\n{"code": "2", "rate": "bad"}\n')
    (root / "empty.json").write_text('{"a": 1}')
    (root / "notes.txt").write_text("x")
    target = str(tmp_path / "lake")
    outcome = {
        r.source_file_name: (r.status, r.rows_loaded)
        for r in lake.run_landing(spark, str(root), target, "run-1").collect()
    }
    assert outcome == {
        "tall.csv": ("success", 2), "wide.csv": ("success", 2), "latin.csv": ("success", 2),
        "services.json": ("success", 2), "lines.json": ("success", 2), "empty.json": ("failed", 0),
        "notes.txt": ("failed", 0),
    }
    registry = {r.source_file_name: r for r in lake.landed(spark, target, "pt_csv_registry").collect()}
    assert (registry["tall.csv"].format_hint, registry["tall.csv"].header_count) == ("TALL", 37)
    assert (registry["wide.csv"].format_hint, registry["wide.csv"].delimiter) == ("WIDE", "|")
    assert registry["latin.csv"].encoding == "latin-1"
    kv = json.loads(registry["latin.csv"].preamble_kv)
    assert kv == {"hospital_name": "Génér", "state": "MO", "license": "1", "version": "2.0"}
    tall = lake.landed(spark, target, "pt_csv_raw_tall").filter("source_file_name = 'tall.csv'")
    raws = sorted((json.loads(r.raw) for r in tall.collect()), key=lambda o: o["_meta_row_number"])
    assert [o["_meta_row_number"] for o in raws] == [4, 5]
    assert raws[0]["description"] == 'A, "quoted" b' and raws[0]["code"] == "85025"
    assert raws[0]["_meta_header_column_count"] == 37
    rates = lake.landed(spark, target, "pt_json_extracted_rates")
    got = {(r.billing_code, r.payer, r.billing_class, r.rate_type, r.record_path,
            None if r.negotiated_rate is None else float(r.negotiated_rate)) for r in rates.collect()}
    assert got == {
        ("85025", "A", "outpatient", "estimated_amount", "standard_charge_information.item", 150.5),
        ("85025", "B", "outpatient", "estimated_amount", "standard_charge_information.item", None),
        ("1", None, None, None, "ndjson_line", 2.5), ("2", None, None, None, "ndjson_line", None),
    }
    compact = json.loads(rates.filter("payer = 'A'").first().raw_rate)
    assert compact["payer"]["estimated_amount"] == 150.5
    assert compact["service"]["description"] == "Visit"
    again = lake.run_landing(spark, str(root), target, "run-2").collect()
    assert {r.source_file_name for r in again} == {"empty.json", "notes.txt"}


def test_landing_survives_crashes(spark, tmp_path, monkeypatch):
    """A run that breaks off between its writes or before its commit leaves nothing to read; the next one loads every row once."""
    root = tmp_path / "drop"
    root.mkdir()
    (root / "tall.csv").write_text(landing_csv(8))
    (root / "lines.json").write_text('{"code": "1", "rate": "2"}\n{"code": "2", "rate": "3"}\n')
    target, write, done = str(tmp_path / "lake"), commits.write, commits.commit

    class Crash(Exception):
        pass

    def crash(*_):
        raise Crash

    for survived in (1, 5):  # the tall rows are there; all but the JSON registry is there
        left = [survived]

        def counted(*args):
            if not left[0]:
                raise Crash
            left[0] -= 1
            write(*args)

        monkeypatch.setattr(commits, "write", counted)
        with pytest.raises(Crash):
            lake.run_landing(spark, str(root), target, "run-1")
    monkeypatch.setattr(commits, "write", write)
    monkeypatch.setattr(commits, "commit", crash)
    with pytest.raises(Crash):
        lake.run_landing(spark, str(root), target, "run-1")
    monkeypatch.setattr(commits, "commit", done)
    counts = {"pt_csv_raw_tall": 2, "pt_csv_raw_wide": 0, "pt_json_raw": 0, "pt_json_extracted_rates": 2,
              "pt_csv_registry": 1, "pt_json_registry": 1}
    assert all(lake.landed(spark, target, table).isEmpty() for table in counts)
    first = lake.run_landing(spark, str(root), target, "run-1").collect()
    assert sorted((r.source_file_name, r.rows_loaded) for r in first) == [("lines.json", 2), ("tall.csv", 2)]
    assert {t: lake.landed(spark, target, t).count() for t in counts} == counts
    assert lake.run_landing(spark, str(root), target, "run-1").isEmpty()
    assert {t: lake.landed(spark, target, t).count() for t in counts} == counts


def test_newest_committed_attempt_counts(spark):
    owners = spark.createDataFrame(
        [("f", "a1"), ("f", "a2"), ("f", "a3"), ("g", "a1"), ("h", "a3"), ("i", "a2"), ("i", "a4")],
        "source_file_name string, attempt string")
    done = spark.createDataFrame([("a1", "r", 1), ("a2", "r", 2), ("a4", "r", 2)], "attempt string, run_id string, t int")
    done = done.select("attempt", "run_id", F.timestamp_seconds("t").alias("committed_at"))
    got = {(r.source_file_name, r.attempt) for r in commits.newest_attempts(owners, done).collect()}
    assert got == {("f", "a2"), ("g", "a1"), ("i", "a4")}


def test_bronze_of_a_broken_run_is_not_read(spark, tmp_path, monkeypatch):
    root = tmp_path / "drop"
    root.mkdir()
    (root / "a.csv").write_text("billing_code,description,gross_charge\n85025,Blood,5\n")
    target, append = str(tmp_path / "lake"), sinks.append

    def crash(*_):
        raise RuntimeError("crash")

    monkeypatch.setattr(sinks, "append", crash)
    with pytest.raises(RuntimeError):
        lake.run_bronze(spark, str(root), target, "2024-01-01")
    monkeypatch.setattr(sinks, "append", append)
    assert sinks.read_bronze(spark, target, "2024-01-01").isEmpty()
    lake.run_bronze(spark, str(root), target, "2024-01-02")
    assert sinks.read_bronze(spark, target, "2024-01-01").isEmpty()
    assert sinks.read_bronze(spark, target, "2024-01-02").count() == 1


def test_preamble_in_pairs(spark):
    row = spark.createDataFrame([(["a", "1", "b", "2", " "], ["x"])], "r1 array<string>, r2 array<string>")
    assert row.select(csv_files.preamble_map(F.col("r1"), F.col("r2"))).first()[0] == {"a": "1", "b": "2"}


def test_structure_profile(spark):
    docs = spark.createDataFrame([(json.dumps(SERVICES),)], "document string")
    found = {r.path: (r.object_count, r.sample_keys) for r in json_files.structure_profile(docs).collect()}
    assert found["standard_charge_information.item"][0] == 1
    payers = found["standard_charge_information.item.standard_charges.item.payers_information.item"]
    assert payers == (2, ["estimated_amount", "methodology", "payer_name", "plan_name"])


def test_json_start(spark):
    df = spark.createDataFrame([("﻿ junk [1]",), ("none",)], "t string")
    assert [r[0] for r in df.select(json_files.json_start(F.col("t"))).collect()] == [8, 0]

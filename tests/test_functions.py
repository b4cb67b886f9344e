"""Expression vectors."""

import pytest
from pyspark.sql import functions as F

from ratelens.functions import codes, names, rates
from ratelens.functions.keys import surrogate_key


def values(spark, rows, column, schema="a string, b string"):
    width = len(schema.split(","))
    data = [tuple(r) if width > 1 else (r,) for r in rows]
    return [r[0] for r in spark.createDataFrame(data, schema).select(column).collect()]


def check(spark, cases, column, schema="a string, b string"):
    got = values(spark, [c[0] for c in cases], column, schema)
    assert list(zip([c[0] for c in cases], got)) == cases


def test_classify(spark):
    cases = [
        ("99213", "CPT"), ("J1234", "HCPCS"), ("12345-6789-01", "NDC"), ("450", "REVENUE"),
        ("0450", "REVENUE"), ("B2151ZZ", "ICD-10-PCS"), ("0DTJ4ZZ", "UNKNOWN"), ("X1?", "UNKNOWN"),
        ("", "CPT"), (None, "CPT"),
    ]
    check(spark, cases, codes.classify_code("a"), "a string")


def test_infer(spark):
    cases = [(("99213", "unknown"), "CPT"), (("99213", None), "CPT"), (("x", " LOCAL "), "LOCAL")]
    check(spark, cases, codes.infer_code_type("a", "b"))


def test_storage(spark):
    cases = [
        (("199213", "CPT"), "99213"), (("01234", "CPT"), "01234"), (("992", "CPT"), "992"),
        ((" j0001 ", "HCPCS"), "J0001"), (("e11.65", "ICD-10-CM"), "E1165"),
        (("0dtj4zz", "ICD_10_PCS"), "0DTJ4ZZ"), (("0002-7510.01", "NDC"), "0002751001"),
        ((" 0450 ", "RC"), "0450"),
    ]
    check(spark, cases, codes.storage_code("a", "b"))


def test_issue(spark):
    cases = [
        (("199213", "CPT"), None), (("9921A", "CPT"), "cpt_expected_5_digits"),
        (("J001", "HCPCS"), "hcpcs_expected_5_alphanum"),
        (("123", "NDC"), "ndc_not_10_or_11_digits"), (("abcdefghij", "NDC"), None),
        (("45", "RC"), "rc_expected_3_or_4_digits"), (("X118?", "CDM"), "cdm_expected_3_or_4_digits"),
        (("470", "MS-DRG"), None), (("47", "MS-DRG"), "drg_expected_3_digits"),
        (("5072", "APC"), None), (("x", "UNKNOWN"), None), (("x", "LOCAL"), "unknown_code_type"),
        (("x", None), "unknown_code_type"), ((None, "CPT"), None), (("ab1c2", "HIPPS"), None),
    ]
    check(spark, cases, codes.code_issue("a", "b"))


def test_names(spark):
    cases = [
        (" Aetna [123] PPO. ", "AETNA PPO"), ("Blue Cross & Blue Shield", "BLUE CROSS BLUE SHIELD"),
        ("United-Healthcare", "UNITED HEALTHCARE"), (None, ""), ("a\tb", "A\tB"),
    ]
    check(spark, cases, names.match_text("a"), "a string")
    check(
        spark,
        [("123_saint_marys-north_standardcharges.csv", "Saint Marys North")],
        names.file_display_name("a"), "a string",
    )
    check(
        spark,
        [("45 0503121 General Hospital", "General Hospital"),
         ("123 Main Street", "123 Main Street")],
        names.clean_hospital_name("a"), "a string",
    )


def test_payer_label(spark):
    cases = [(("A", "B"), "A | B"), (("A", None), "A"), ((None, "B"), "B"), ((None, None), "")]
    check(spark, cases, names.payer_plan_label("a", "b"))


def test_parse_rate(spark):
    cases = [
        ("$1,150.00", 1150.0), ("12.5 per day", 12.5), ("-3", -3.0), ("n/a", None), ("NA", None),
        ("null", None), ("-", None), ("", None), ("abc", None), (None, None),
    ]
    check(spark, cases, rates.parse_rate("a"), "a string")


def test_strict_amount(spark):
    cases = [
        ("150.00", 150.0), ("$150", None), ("", None), (" 7 ", 7.0), ("1e3", 1000.0),
        ("nan", None), ("inf", None), ("1e999", None), ("5d", None),
    ]
    check(spark, cases, rates.strict_amount("a"), "a string")


@pytest.mark.parametrize(
    "kind, amount, gross, expected",
    [
        ("negotiated_dollar", 1.0, None, "negotiated"),
        (" Negotiated_Percentage ", 1.0, None, "percentage"),
        ("charge", 1.0, None, "gross"), ("discounted_cash_price", 1.0, None, "cash"),
        ("minimum", 1.0, None, "min"), ("max", 1.0, None, "max"), ("", 5.0, 5.0, "gross"),
        ("", 5.0, 4.0, "negotiated"), (None, 5.0, None, "negotiated"),
        ("bundled_rate", 5.0, 5.0, "other"),
    ],
)
def test_category(spark, kind, amount, gross, expected):
    df = spark.createDataFrame(
        [(kind, amount, gross, None, None, None)],
        "k string, a double, g double, c double, mn double, mx double",
    )
    assert df.select(rates.rate_category("k", "a", "g", "c", "mn", "mx")).first()[0] == expected


def test_comparability(spark):
    df = spark.createDataFrame([("CPT", "gross", "dollars"), ("CPT", "other", "dollars"),
                                ("CPT", "weird", "")], "t string, c string, u string")
    got = [tuple(r) for r in df.select(
        rates.comparability_key("t", "c", "u"), rates.comparability_reason("c")).collect()]
    assert got == [("CPT|gross|dollars", "comparable"), ("CPT|other|dollars", "excluded_other"),
                   ("CPT|weird|", "excluded_unexpected_category")]


def test_surrogate_key_tells_null_from_blank(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "a string, b string")
    keys = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    assert len(set(keys)) == 2


def test_safe_preview(spark):
    text = "a\x00b\n  c" + "x" * 300
    got = values(spark, [text], names.safe_preview("a"), "a string")[0]
    assert got.startswith("a b c") and got.endswith("...") and len(got) == 203
    assert values(spark, [None], names.safe_preview(F.col("a")), "a string") == [""]

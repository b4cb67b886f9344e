"""Billing codes: type inference, storage form and validation."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelens.functions import as_col, text

# Code families and what a well-formed code of each looks like.
FIVE_DIGITS = "^[0-9]{5}$"
THREE_OR_FOUR_DIGITS = "^[0-9]{3,4}$"
THREE_DIGITS = "^[0-9]{3}$"
FOUR_DIGITS = "^[0-9]{4}$"
TEN_OR_ELEVEN = "(?s)^.{10,11}$"
FIVE_ALPHANUMERIC = "^[A-Z0-9]{5}$"
SEVEN_ALPHANUMERIC = "^[A-Z0-9]{7}$"
THREE_TO_SEVEN_ALPHANUMERIC = "^[A-Z0-9]{3,7}$"
DRG_TYPES = ("DRG", "MS_DRG", "APR_DRG", "TRIS_DRG")
APC_TYPES = ("APC", "EAPG")
KNOWN_CODE_TYPES = (
    "CPT", "HCPCS", "NDC", "REVENUE", "ICD_10_PCS", "UNKNOWN", "DRG", "MS_DRG", "APC",
    "EAPG", "ICD_10_CM", "RC", "CDM", "8", "APR_DRG", "ICD", "TRIS_DRG", "HIPPS",
)
HARD_FORMATS = {
    "CPT": FIVE_DIGITS,
    "HCPCS": FIVE_ALPHANUMERIC,
    "DRG": THREE_DIGITS,
    "MS_DRG": THREE_DIGITS,
    "APR_DRG": THREE_DIGITS,
    "TRIS_DRG": THREE_DIGITS,
    "APC": FOUR_DIGITS,
    "EAPG": FOUR_DIGITS,
    "HIPPS": FIVE_ALPHANUMERIC,
    "ICD_10_PCS": SEVEN_ALPHANUMERIC,
    "ICD_10_CM": THREE_TO_SEVEN_ALPHANUMERIC,
    "REVENUE": FOUR_DIGITS,
    "RC": FOUR_DIGITS,
}


def _strip(column: Column, *characters: str) -> Column:
    for character in characters:
        column = F.replace(column, F.lit(character), F.lit(""))
    return column


def code_type_norm(code_type) -> Column:
    """Upper-case, trimmed type with underscores; NULL becomes blank."""
    return F.upper(F.replace(F.trim(text(code_type)), F.lit("-"), F.lit("_")))


def code_type_or_unknown(code_type) -> Column:
    """As ``code_type_norm`` but NULL becomes UNKNOWN (a blank type stays blank)."""
    normed = F.upper(
        F.replace(F.trim(as_col(code_type).cast("string")), F.lit("-"), F.lit("_"))
    )
    return F.coalesce(normed, F.lit("UNKNOWN"))


def classify_code(code) -> Column:
    """Guess the type from the shape of the code.  A blank code reads as CPT."""
    bare = _strip(F.trim(text(code)), "-", " ")
    size = F.length(bare)
    return (
        F.when((bare == "") | bare.rlike(FIVE_DIGITS), "CPT")
        .when(bare.rlike("^[A-Za-z][0-9]{4}$"), "HCPCS")
        .when(size.isin(10, 11) & bare.rlike("^[0-9]+$"), "NDC")
        .when(bare.rlike(THREE_OR_FOUR_DIGITS), "REVENUE")
        .when(bare.rlike("^[A-Za-z][0-9A-Za-z]{6}$"), "ICD-10-PCS")
        .otherwise("UNKNOWN")
    )


def infer_code_type(code, code_type) -> Column:
    """Keep a stated type; guess when it is missing, blank or ``unknown``."""
    stated = F.trim(text(code_type))
    return F.when(F.lower(stated).isin("unknown", ""), classify_code(code)).otherwise(stated)


def _tail(bare: Column) -> Column:
    return F.when(F.length(bare) >= 5, F.right(bare, F.lit(5))).otherwise(bare)


def stored_form(kind, code) -> Column:
    """The form a code of a normalised type is stored in.

    CPT keeps its last five characters; HCPCS, ICD and NDC lose case and punctuation.
    """
    kind = as_col(kind)
    bare = F.trim(as_col(code).cast("string"))
    return (
        F.when(kind == "CPT", _tail(bare))
        .when(kind.isin("HCPCS", "ICD_10_PCS"), F.upper(bare))
        .when(kind == "ICD_10_CM", _strip(F.upper(bare), "."))
        .when(kind == "NDC", _strip(bare, "-", " ", "."))
        .otherwise(bare)
    )


def storage_code(code, code_type) -> Column:
    """``stored_form`` for a raw type."""
    return stored_form(code_type_norm(code_type), code)


def validation_code(code, code_type) -> Column:
    """The form a code is checked in by the format check: upper case, per-type punctuation dropped."""
    kind = code_type_norm(code_type)
    bare = F.upper(F.trim(text(code)))
    return (
        F.when(kind == "ICD_10_CM", _strip(bare, "."))
        .when(kind == "NDC", _strip(bare, "-", " "))
        .otherwise(bare)
    )


def issue_of(kind, code) -> Column:
    """Why a code is malformed for its normalised type, NULL when it is fine.

    Each type is met by one branch that looks at that type's stored form only, which keeps the
    generated code small.  A NULL code raises no issue.
    """
    kind = as_col(kind)
    bare = F.trim(as_col(code).cast("string"))
    upper = F.upper(bare)
    rules = [
        (["CPT"], _tail(bare), FIVE_DIGITS, "cpt_expected_5_digits"),
        (["HCPCS"], upper, FIVE_ALPHANUMERIC, "hcpcs_expected_5_alphanum"),
        (["NDC"], _strip(bare, "-", " ", "."), TEN_OR_ELEVEN, "ndc_not_10_or_11_digits"),
        (["REVENUE"], bare, THREE_OR_FOUR_DIGITS, "revenue_expected_3_or_4_digits"),
        (["RC"], bare, THREE_OR_FOUR_DIGITS, "rc_expected_3_or_4_digits"),
        (["CDM"], bare, THREE_OR_FOUR_DIGITS, "cdm_expected_3_or_4_digits"),
        (["ICD_10_PCS"], upper, SEVEN_ALPHANUMERIC, "icd_10_pcs_expected_7_alphanum"),
        (["ICD_10_CM"], _strip(upper, "."), THREE_TO_SEVEN_ALPHANUMERIC,
         "icd_10_cm_expected_3_to_7_alphanum"),
        (DRG_TYPES, bare, THREE_DIGITS, "drg_expected_3_digits"),
        (["HIPPS"], upper, FIVE_ALPHANUMERIC, "hipps_expected_5_alphanum"),
        (APC_TYPES, bare, FOUR_DIGITS, "apc_eapg_expected_4_digits"),
    ]
    types, form, pattern, reason = rules[0]
    issue = F.when(kind.isin(*types), F.when(~form.rlike(pattern), reason))
    for types, form, pattern, reason in rules[1:]:
        issue = issue.when(kind.isin(*types), F.when(~form.rlike(pattern), reason))
    return issue.when(~kind.isin(*KNOWN_CODE_TYPES), "unknown_code_type")


def code_issue(code, code_type) -> Column:
    """``issue_of`` for a raw type."""
    return issue_of(code_type_norm(code_type), code)


def code_is_valid(code, code_type) -> Column:
    return code_issue(code, code_type).isNull()

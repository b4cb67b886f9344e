"""Free text: payer and plan names, hospital names, previews of bad input."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelens.functions import as_col, blank_to_null, text

# Preamble keys that may hold the facility name, in order of preference.
NAME_KEYS = ("hospital_name", "hospital", "facility_name", "Hospital Name", "Facility Name")
STAGING_NAME_KEYS = NAME_KEYS[:3]
# Fixed value: a facility id in front of a name, e.g. "45 0503121 General Hospital".
FACILITY_PREFIX = r"^\d{1,3}\s+\d{5,}\s*"


def match_text(value) -> Column:
    """Form used to match names: no ``[123]`` marks, no punctuation, single spaces, upper case."""
    unmarked = F.regexp_replace(text(value), r"\[\d+\]", "")
    # One pass turns every run of punctuation and spaces into a single space.
    return F.upper(F.trim(F.regexp_replace(unmarked, r"[^a-zA-Z0-9\t\n\x0b\f\r]+", " ")))


def file_stem(file_name) -> Column:
    """Lower-case words of a file name without extension, id prefix and standard suffix."""
    stem = F.regexp_replace(F.lower(text(file_name)), r"\.(csv|json)$", "")
    stem = F.regexp_replace(stem, r"_standardcharges$", "")
    stem = F.regexp_replace(stem, r"^\d+_", "")
    return F.trim(F.regexp_replace(stem, r"[_\-\s]+", " "))


def file_display_name(file_name) -> Column:
    return F.initcap(file_stem(file_name))


def preamble_name(preamble_json, keys=NAME_KEYS) -> Column:
    """First non-blank facility name among ``keys`` of a preamble stored as JSON text."""
    return F.coalesce(
        *[blank_to_null(F.get_json_object(as_col(preamble_json), f"$['{key}']")) for key in keys]
    )


def clean_hospital_name(name) -> Column:
    """Single-spaced name without the facility-id prefix; may be blank."""
    spaced = F.trim(F.regexp_replace(as_col(name), r"[_\-\s]+", " "))
    return F.trim(F.regexp_replace(spaced, FACILITY_PREFIX, ""))


def hospital_match_name(clean_name) -> Column:
    """Lower-case letters, digits and single spaces; may be blank."""
    plain = F.regexp_replace(F.lower(as_col(clean_name)), r"[^a-z0-9\s]", "")
    return F.trim(F.regexp_replace(plain, " +", " "))


def payer_plan_label(payer, plan) -> Column:
    """``payer | plan`` without dangling separators."""
    return F.btrim(F.concat(text(payer), F.lit(" | "), text(plan)), F.lit(" |"))


def safe_preview(value, limit: int = 200) -> Column:
    """Printable single-line extract of at most ``limit`` characters for error messages."""
    head = F.substring(text(value), 1, 2 * limit)
    printable = F.regexp_replace(head, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ")
    line = F.trim(F.regexp_replace(printable, r"\s+", " "))
    return F.when(
        F.length(line) > limit, F.concat(F.substring(line, 1, limit), F.lit("..."))
    ).otherwise(line)

"""Reading VARIANT values the way loosely typed files need."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelens.functions import as_col, blank_to_null, bound

# How values that count as absent look as text: zero, false and empty containers.
FALSY = ("0", "0.0", "-0.0", "false", "{}", "[]")


def as_text(value) -> Column:
    return F.try_variant_get(as_col(value), "$", "string")


def items(value) -> Column:
    """The elements of an array, NULL for anything else."""
    return F.try_variant_get(as_col(value), "$", "array<variant>")


def members(value, *names: str) -> Column:
    """The named members of an object as a struct of variants, NULL for anything else."""
    fields = ", ".join(f"`{n}` variant" for n in names)
    return F.try_variant_get(as_col(value), "$", f"struct<{fields}>")


def present(value) -> Column:
    """Neither missing nor JSON null."""
    return as_col(value).isNotNull() & ~F.is_variant_null(as_col(value))


def truthy_text(value) -> Column:
    """The value as text unless it is null, blank, zero, false or empty."""

    def of(own: Column) -> Column:
        is_string = F.schema_of_variant(own) == "STRING"
        return bound(
            as_text(own),
            lambda shown: F.when(F.when(is_string, shown != "").otherwise(~shown.isin(*FALSY)), shown),
        )

    return bound(as_col(value), of)


def number(value) -> Column:
    """A JSON number as it is, exponent included; NULL for anything else."""
    is_number = F.schema_of_variant(as_col(value)).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    return F.when(is_number, F.try_variant_get(as_col(value), "$", "double"))


def first_truthy(values: list[Column]) -> Column:
    """The first value that is not null, blank, zero, false or empty."""
    return F.get(F.filter(F.array(*values), lambda v: v.isNotNull() & truthy_text(v).isNotNull()), F.lit(0))


def first_of(values: list[Column], reader) -> Column:
    """What ``reader`` makes of the first value it does not turn into NULL; it turns NULL into NULL."""
    read = F.transform(F.filter(F.array(*values), lambda v: v.isNotNull()), reader)
    return F.get(F.filter(read, lambda v: v.isNotNull()), F.lit(0))


def first_present(values: list[Column]) -> Column:
    """The first value that is present, whatever it holds."""
    return F.get(F.filter(F.array(*values), present), F.lit(0))


def first_text(values: list[Column]) -> Column:
    """The first present value as trimmed text; later ones only replace absent ones."""
    return blank_to_null(as_text(first_present(values)))


def top_level(text: Column, *names: str) -> Column:
    """A top-level member of a JSON object by name, ignoring case; earlier names win."""

    def named(found: Column, name: str) -> Column:
        matches = F.map_filter(found, lambda key, _: F.lower(key) == name.lower())
        return F.get(F.map_values(matches), F.lit(0))

    return bound(
        F.from_json(text, "map<string,variant>"),
        lambda found: F.coalesce(*[named(found, n) for n in names]),
    )

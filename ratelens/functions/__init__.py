"""Column builders.  Every function takes and returns Columns, so it runs inside codegen."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often ``use`` names it.

    Lambdas know no common subexpressions: what is named in several places there is computed in each of them.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text(value) -> Column:
    """The value as a string, NULL read as blank."""
    return F.coalesce(as_col(value).cast("string"), F.lit(""))


def blank_to_null(value) -> Column:
    trimmed = F.trim(as_col(value).cast("string"))
    return F.when(trimmed != "", trimmed)


def first_present(*values) -> Column:
    """First value that is neither NULL nor blank, trimmed."""
    return F.coalesce(*[blank_to_null(v) for v in values])

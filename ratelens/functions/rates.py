"""Amounts, rate categories and comparability."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelens.functions import as_col, text

# Rate types as files spell them, by the category they belong to.
RATE_TYPES = {
    "negotiated": (
        "negotiated_rate", "negotiated_dollar", "negotiated", "estimated_amount",
        "estimated", "self_pay", "self_pay_rate", "self-pay",
    ),
    "percentage": ("negotiated_percentage", "percentage"),
    "gross": ("gross_charge", "gross", "standard_charge_gross", "standard_charge", "charge"),
    "cash": ("discounted_cash", "discounted_cash_price", "cash_price", "cash"),
    "min": ("min", "minimum"),
    "max": ("max", "maximum"),
}
# Rate types that already are the typed column's own row.
TYPED_COLUMNS = {
    "gross": ("gross_charge", ("gross_charge", "gross", "standard_charge_gross")),
    "cash": ("discounted_cash", ("discounted_cash", "cash_price", "cash")),
    "min": ("minimum", ("min", "minimum")),
    "max": ("maximum", ("max", "maximum")),
}
# Rate types of the lake path.
LAKE_RATE_TYPES = {
    "negotiated": ("NEGOTIATED", "NEGOTIATED_RATE"),
    "gross": ("GROSS", "GROSS_CHARGE"),
    "cash": ("CASH", "DISCOUNTED_CASH_PRICE"),
    "min": ("MINIMUM",),
    "max": ("MAXIMUM",),
}
COMPARABLE_CATEGORIES = ("negotiated", "gross", "cash", "min", "max", "percentage")
RATE_CATEGORIES = COMPARABLE_CATEGORIES + ("other",)
# Spellings of a missing amount.
NO_AMOUNT = ("n/a", "na", "null", "-")
PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def finite(amount: Column) -> Column:
    """NaN and infinities count as missing."""
    return F.when(~F.isnan(amount) & (F.abs(amount) < F.lit(float("inf"))), amount)


def parse_rate(value) -> Column:
    """Amount in a free-text cell: currency signs and thousands commas dropped, first number taken."""
    trimmed = F.trim(as_col(value).cast("string"))
    digits = F.regexp_extract(F.regexp_replace(trimmed, r"[$,]", ""), r"-?\d+\.?\d*", 0)
    return F.when(~F.lower(trimmed).isin(*NO_AMOUNT), digits.try_cast("double"))


def strict_amount(value) -> Column:
    """Amount when the whole cell is a plain number, else NULL."""
    trimmed = F.trim(as_col(value).cast("string"))
    return finite(F.when(trimmed.rlike(PLAIN_NUMBER), trimmed.try_cast("double")))


def numeric(value) -> Column:
    """Amount as stored in landing tables."""
    return as_col(value).try_cast("decimal(38,9)")


def rate_type_norm(rate_type) -> Column:
    return F.lower(F.trim(text(rate_type)))


def category_of(kind, amount, gross, cash, minimum, maximum) -> Column:
    """Category for a normalised rate type.  A blank one takes that of the column it repeats."""
    kind = as_col(kind)
    (name, spellings), *others = RATE_TYPES.items()
    category = F.when(kind.isin(*spellings), name)
    for name, spellings in others:
        category = category.when(kind.isin(*spellings), name)
    for name, typed in zip(("gross", "cash", "min", "max"), (gross, cash, minimum, maximum)):
        category = category.when((kind == "") & (as_col(amount) == as_col(typed)), name)
    return category.when(kind == "", "negotiated").otherwise("other")


def rate_category(rate_type, *amounts) -> Column:
    """``category_of`` for a raw rate type; ``amounts`` as there."""
    return category_of(rate_type_norm(rate_type), *amounts)


def lake_rate_category(rate_type) -> Column:
    kind = F.upper(text(rate_type))
    (name, spellings), *others = LAKE_RATE_TYPES.items()
    category = F.when(kind.isin(*spellings), name)
    for name, spellings in others:
        category = category.when(kind.isin(*spellings), name)
    return category.otherwise("other")


def unit_of(kind) -> Column:
    """Unit for a normalised rate type."""
    return F.when(as_col(kind).contains("percent"), "percent").otherwise("dollars")


def rate_unit(rate_type) -> Column:
    return unit_of(rate_type_norm(rate_type))


def comparability_key(code_type, category, unit) -> Column:
    return F.concat_ws("|", text(code_type), F.lower(F.trim(text(category))), F.trim(text(unit)))


def comparability_reason(category) -> Column:
    kind = F.lower(F.trim(text(category)))
    return (
        F.when(kind == "other", "excluded_other")
        .when(~kind.isin(*RATE_CATEGORIES), "excluded_unexpected_category")
        .otherwise("comparable")
    )


def money_total(amount) -> Column:
    """Sum of an amount that does not depend on the order rows arrive in."""
    return F.sum(as_col(amount).cast("decimal(28,4)")).cast("double")

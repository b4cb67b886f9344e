"""Row and entity keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratelens.functions import as_col

# Fixed value: what a NULL part contributes to a surrogate key.
NULL_PART = "_ratelens_no_value_"


def surrogate_key(*parts) -> Column:
    """MD5 over the parts as text, joined by ``-``."""
    return F.md5(
        F.concat_ws(
            "-", *[F.coalesce(as_col(p).cast("string"), F.lit(NULL_PART)) for p in parts]
        )
    )


def name_key(name) -> Column:
    """Entity id from a name, ignoring case and outer blanks."""
    return F.md5(F.lower(F.trim(as_col(name))))


def amount_text(amount) -> Column:
    """Amount as fixed-point text, the same for every way the number is written."""
    return as_col(amount).cast("decimal(38,9)").cast("string")

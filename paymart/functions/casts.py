"""Lenient casts from raw strings.

The raw layer is all strings.  A bad value must become NULL rather than fail
the job, whatever ``spark.sql.ansi.enabled`` says, so every cast goes through
``try_cast``.  Integer casts keep the lenient behaviour of non-ANSI Spark for
fractional text (``'12.5'`` -> 12, truncation toward zero) by passing through a
wide decimal first.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from paymart.functions._col import col

# Fixed value: the intermediate type for string -> integer casts.
WIDE_DECIMAL = "decimal(38,18)"


def to_int(c: "str | Column") -> Column:
    """String to INT; unparsable or out-of-range text is NULL, fractions truncate.

    Plain integers take the cheap direct cast; only text that fails it goes
    through the wide-decimal parse.
    """
    x = col(c)
    return F.coalesce(x.try_cast("int"), x.try_cast(WIDE_DECIMAL).try_cast("int"))


def to_decimal(c: "str | Column", precision: int = 10, scale: int = 2) -> Column:
    """String to DECIMAL(p,s) rounding HALF_UP; unparsable or overflowing text is NULL."""
    return col(c).try_cast(f"decimal({precision},{scale})")


def to_date(c: "str | Column") -> Column:
    """String to DATE; invalid text is NULL."""
    return col(c).try_cast("date")

"""Calendar expressions: integer date key and fiscal attributes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from paymart.functions._col import col

# The fiscal year starts in April (April-June is quarter 1).
FISCAL_START_MONTH = 4


def date_key(c: "str | Column") -> Column:
    """DATE to the integer key yyyyMMdd (NULL stays NULL)."""
    return F.date_format(col(c), "yyyyMMdd").cast("int")


def fiscal_year(c: "str | Column") -> Column:
    d = col(c)
    return F.when(F.month(d) >= FISCAL_START_MONTH, F.year(d)).otherwise(F.year(d) - 1)


def fiscal_quarter(c: "str | Column") -> Column:
    """1 to 4, counted in threes of months from the fiscal year's first month."""
    months_in = F.pmod(F.month(col(c)) - F.lit(FISCAL_START_MONTH), F.lit(12))
    return (F.floor(months_in / 3) + 1).cast("int")


def is_weekend(c: "str | Column") -> Column:
    """1 on Saturday and Sunday (``dayofweek`` 7 and 1), else 0."""
    return F.when(F.dayofweek(col(c)).isin(1, 7), 1).otherwise(0)

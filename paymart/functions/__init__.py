"""Column-expression builders (pure, JVM-side, codegen friendly)."""

from paymart.functions.casts import to_date, to_decimal, to_int
from paymart.functions.clean import initcap_trim, lower_trim, trim, upper_trim
from paymart.functions.dates import (
    date_key,
    fiscal_quarter,
    fiscal_year,
    is_weekend,
)
from paymart.functions.hashing import record_hash
from paymart.functions.money import pct_rate, round_avg

__all__ = [
    "to_int", "to_decimal", "to_date",
    "trim", "lower_trim", "upper_trim", "initcap_trim",
    "date_key", "fiscal_year", "fiscal_quarter", "is_weekend",
    "record_hash",
]

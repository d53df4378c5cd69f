"""Exact money arithmetic for reports.

Measures are DECIMAL(10,2).  Averages and rates are rounded HALF_UP to two
places on the exact rational value: the quotient is formed with integer
division over DECIMAL(38,0) operands (no overflow at any realistic volume)
and the result is a DECIMAL(22,2).  Floating-point rounding therefore never
decides a digit, and the value is identical across engines.  Inputs are non-negative (the silver layer rejects negative
amounts), which the floor-division formula relies on.

The helpers take the *names* of aggregated columns, because they run after
an aggregation (``round_avg("sum_amount", "n")``).
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _half_up_div(num_sql: str, den_sql: str) -> str:
    # floor((2*num + den) / (2*den)) == round_half_up(num / den) for num >= 0, den > 0
    num = f"cast({num_sql} as decimal(38,0))"
    return f"((2 * {num} + {den_sql}) div (2 * {den_sql}))"


def round_avg(sum_col: str, n_col: str) -> Column:
    """sum / n (a DECIMAL(p,2) sum over n rows), HALF_UP to 0.01, as DECIMAL(22,2)."""
    q = _half_up_div(f"{sum_col} * 100", n_col)
    return F.expr(f"cast(cast({q} as decimal(20,0)) * 0.01 as decimal(22,2))")


def pct_rate(flag_sum_col: str, n_col: str) -> Column:
    """flag_sum * 100 / n, HALF_UP to two places, as DECIMAL(22,2)."""
    q = _half_up_div(f"{flag_sum_col} * 10000", n_col)
    return F.expr(f"cast(cast({q} as decimal(20,0)) * 0.01 as decimal(22,2))")

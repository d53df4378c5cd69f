"""Calendar dimension: one row per day with civil and fiscal attributes."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart.functions.dates import date_key, fiscal_quarter, fiscal_year, is_weekend

# The default calendar range.
DEFAULT_START = "2018-01-01"
DEFAULT_END = "2030-12-31"
#: Dates outside this range are taken for errors by ``dim_date_covering``.
EARLIEST, LATEST = "1900-01-01", "2100-12-31"

DIM_DATE_COLUMNS = [
    "full_date", "date_key", "year", "quarter", "month", "month_name",
    "week_of_year", "day_of_week", "day_name", "is_weekend", "fiscal_year",
    "fiscal_quarter",
]


def _attributes(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    return days.select(
        d,
        date_key(d).alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        is_weekend(d).alias("is_weekend"),
        fiscal_year(d).alias("fiscal_year"),
        fiscal_quarter(d).alias("fiscal_quarter"),
    )


def dim_date(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    """Every day from ``start`` to ``end`` inclusive, made by a distributed range."""
    first, last = datetime.date.fromisoformat(start), datetime.date.fromisoformat(end)
    days = spark.range((last - first).days + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("full_date"))
    return _attributes(days)


def dim_date_covering(
    dates: DataFrame, date_col: str, earliest: str = EARLIEST, latest: str = LATEST, also: tuple[str, str] | None = None
) -> DataFrame:
    """Whole calendar years spanning the min..max of ``date_col`` (and of ``also``, a range to keep covered).

    NULLs and dates outside ``earliest`` .. ``latest`` (typing errors such as
    the year 9999) are left out of the range; ``fact_quality`` counts facts
    whose date has no calendar row.  The range is one distributed min/max; the
    calendar holds at most 366 rows per covered year.
    """
    sane = F.col(date_col).between(F.lit(earliest).cast("date"), F.lit(latest).cast("date"))
    lo, hi = dates.where(sane).agg(F.min(date_col), F.max(date_col)).first()
    bounds = [d for d in (lo, hi) if d is not None] + [datetime.date.fromisoformat(d) for d in also or ()]
    if not bounds:
        return dim_date(dates.sparkSession, "2000-01-02", "2000-01-01")  # no days
    return dim_date(dates.sparkSession, f"{min(bounds).year:04d}-01-01", f"{max(bounds).year:04d}-12-31")

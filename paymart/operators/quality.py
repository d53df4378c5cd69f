"""Row filters of the silver layer and one-pass quality profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted transaction statuses.
VALID_STATUSES = ["SUCCESS", "FAILED", "PENDING"]


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``keys`` is NULL."""
    return df.dropna(how="any", subset=list(keys))


def is_valid_transaction() -> Column:
    """Non-negative amount and a known status (NULL status is rejected)."""
    return (F.col("txn_amount") >= 0) & F.col("txn_status").isin(VALID_STATUSES)


def valid_transactions(df: DataFrame) -> DataFrame:
    return df.filter(is_valid_transaction())


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1))).cast("bigint")

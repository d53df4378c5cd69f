"""Deterministic deduplication by natural key.

``dropDuplicates`` keeps an arbitrary row, and which one can change when a
lost task is recomputed.  Here the survivor is the first row of a total
order: caller-given priority columns first, then every remaining column
ascending with NULLs last.  ``row_number() == 1`` over a window partitioned
by the key plans as a WindowGroupLimit, so each map task keeps one row per
key before the shuffle: a key holding a third of all rows reaches its reduce
task as at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_order(df: DataFrame, keys: Sequence[str], desc_first: Sequence[str] = ()) -> list[Column]:
    """``desc_first`` descending (NULLs last), then every other non-key column
    ascending (NULLs last): a total order over the distinguishable rows."""
    first = [F.col(c).desc_nulls_last() for c in desc_first]
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys and c not in desc_first]
    return [*first, *rest]


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per ``keys``: the first in ``order`` (default: all columns ascending)."""
    order = list(order) if order is not None else total_order(df, keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")

"""Dense, deterministic surrogate keys without a global sort.

Keys are ``offset + 1 .. offset + n`` in the order
``(substr(md5(natural_key), 1, d), natural_key)`` with ``d = 4`` hex digits
by default.  The hash prefix spreads rows evenly over at most 16**d = 65,536
buckets, so a numbering task holds about n / 65,536 rows (15k per billion).
Rows are counted per bucket (a map-side combined aggregate), the at most
16**d counts get a prefix sum in one small window (a bounded single
partition), and that table (about 1 MB) is broadcast back so every bucket
numbers its own rows in parallel.  The key depends only on the data, never on partition
ids, so recomputing a lost task yields the same key.

The offset (e.g. the largest key of the previous image) is a number, or a
one-row frame that is folded into the prefix sum as a pseudo-bucket ``''`` that
sorts before every hex prefix, so no cross join is needed.

A caller that knows that the rows are few (``rows``, from a catalog) gets the
same keys from one window: at most ``SMALL_ROWS`` rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_DIGITS = 4
SMALL_ROWS = 200_000


def dense_keys(
    df: DataFrame,
    natural_key: str,
    key_col: str,
    offset: DataFrame | int | None = None,
    bucket_digits: int = DEFAULT_BUCKET_DIGITS,
    rows: int | None = None,
) -> DataFrame:
    """Add ``key_col``; ``natural_key`` must be unique and non-NULL in ``df``.

    ``offset`` is the value to start after, or an optional one-row, one-column
    DataFrame that holds it (NULL counts as 0).  ``rows``: a known bound on the rows of ``df``.
    """
    if not 1 <= bucket_digits <= 5:
        raise ValueError("bucket_digits must be 1 to 5: the bucket counts pass one task and are broadcast")
    b = "_key_bucket"
    found = df.withColumn(b, F.substring(F.md5(F.col(natural_key).cast("string")), 1, bucket_digits))
    if rows is not None and rows <= SMALL_ROWS and (offset is None or isinstance(offset, int)):
        number = F.row_number().over(Window.orderBy(b, F.col(natural_key)))
        return found.withColumn(key_col, (F.lit(offset or 0) + number).cast("bigint")).drop(b)
    if isinstance(offset, int):
        offset = df.sparkSession.range(1).select(F.lit(offset).cast("bigint").alias("_offset"))
    counts = found.groupBy(b).agg(F.count(F.lit(1)).cast("bigint").alias("_n"))
    if offset is not None:
        first = offset.columns[0]
        counts = counts.unionByName(
            offset.select(F.lit("").alias(b), F.coalesce(F.col(first).cast("bigint"), F.lit(0)).cast("bigint").alias("_n"))
        )
    # At most 16**d + 1 rows: a single-partition window is bounded and cheap here.
    prefix = Window.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counts.withColumn("_start", F.coalesce(F.sum("_n").over(prefix), F.lit(0)).cast("bigint"))
        .filter(F.col(b) != "")
        .select(b, "_start")
    )
    within = Window.partitionBy(b).orderBy(F.col(natural_key))
    return (
        found.join(F.broadcast(starts), b)
        .withColumn(key_col, (F.col("_start") + F.row_number().over(within)).cast("bigint"))
        .drop(b, "_start")
    )


def max_key(df: DataFrame, key_col: str) -> DataFrame:
    """One-row DataFrame with the largest key (NULL for an empty image)."""
    return df.agg(F.max(key_col).alias("_max_key"))

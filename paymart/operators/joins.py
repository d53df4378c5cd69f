"""Dimension lookups and the point-in-time (as-of) join.

Broadcast policy: a dimension is broadcast only after a measured check that it
holds at most ``max_rows`` rows and that its rows, fixed-width columns and the
bytes of its text, stay below ``MAX_BROADCAST_BYTES``.  The check is one
distributed aggregate; a caller that recorded rows and longest text when it wrote
the table passes them to ``known_to_fit`` instead.  Above the bound the join is a
shuffle join; the result is the same.

Skew policy of the shuffle joins (``spread_join``): a merchant or customer may
own a third of all facts, and many facts may have no key at all.  Keys with
enough facts are found by a map-side combined count; their facts are spread
over ``salt_buckets`` sub-keys by a hash of the row (deterministic, so
recomputed tasks route rows identically) and their few dimension rows are
replicated to every sub-key.  Facts without a key match nothing and are spread
the same way.  A key is hot from ``max(hot_key_rows, ceil(rows / max_hot_keys))``
facts on, so by arithmetic at most ``max_hot_keys`` keys are, and the table of
hot keys can always be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

from paymart.sources.storage import new_table_path, read_table, write_table

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 << 20
DEFAULT_HOT_KEY_ROWS = 5_000_000
DEFAULT_SALT_BUCKETS = 64
DEFAULT_MAX_HOT_KEYS = 1_000_000


def row_width(schema: StructType) -> int:
    """Bytes of a row in a broadcast table without the bytes of its text."""
    return 16 + 16 * len(schema.fields)


def fits(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes, its text measured (one distributed aggregate)."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, (StringType, BinaryType))]
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(text, F.lit(0)).cast("bigint")), F.lit(0))).first()
    return rows <= max_rows and rows * row_width(df.schema) + size <= max_bytes


def known_to_fit(rows: int, longest: int, columns: int, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """``fits`` from recorded figures: rows, bytes of the longest text of a row, columns."""
    return rows <= max_rows and rows * (16 + 16 * columns + longest) <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if it passes the size bound, else ``df`` unchanged."""
    return F.broadcast(df) if fits(df, max_rows) else df


def hot_keys(
    fact: DataFrame, key: str, hot_key_rows: int = DEFAULT_HOT_KEY_ROWS, max_hot_keys: int = DEFAULT_MAX_HOT_KEYS
) -> DataFrame:
    """The keys of ``fact`` with the most rows, one column ``_hot_key``; written once, at most ``max_hot_keys`` rows.

    Call it on the narrowest form of the fact, before other joins.
    """
    spark = fact.sparkSession
    keys = fact.select(key).where(F.col(key).isNotNull())
    least = max(hot_key_rows, -(-keys.count() // max_hot_keys))
    hot = keys.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select(F.col(key).alias("_hot_key"))
    return read_table(spark, write_table(hot, new_table_path(spark, "hot-keys")), hot.schema)


def spread_join(fact: DataFrame, dim: DataFrame, key: str, dim_key: str, hot: DataFrame, extra: Column | None = None, how: str = "left", salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Shuffle join on ``fact[key] = dim[dim_key]`` (and ``extra``) with hot and missing keys spread.

    ``dim_key`` must not be a column of ``fact``; it is dropped from the result.
    """
    hot = F.broadcast(hot.withColumn("_is_hot", F.lit(True)))
    f = fact.join(hot, F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_salt",
        F.when(F.col("_is_hot") | F.col(key).isNull(), F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salt_buckets)))
        .otherwise(F.lit(0)).cast("int"),
    ).drop("_hot_key", "_is_hot")
    # Above the bound the dimension must not be broadcast from a wrong estimate either.
    d = dim.join(hot, F.col(dim_key) == F.col("_hot_key"), "left").withColumn(
        "_d_salt",
        F.explode(F.when(F.col("_is_hot"), F.sequence(F.lit(0), F.lit(salt_buckets - 1))).otherwise(F.array(F.lit(0)))),
    ).drop("_hot_key", "_is_hot")
    on = (F.col(key) == F.col(dim_key)) & (F.col("_salt") == F.col("_d_salt"))
    return f.join(d.hint("merge"), on if extra is None else on & extra, how).drop(dim_key, "_salt", "_d_salt")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    how: str = "left",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    hot: DataFrame | None = None,
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
    max_hot_keys: int = DEFAULT_MAX_HOT_KEYS,
    small: bool | None = None,
) -> DataFrame:
    """Equi-join a (slim) dimension onto the fact: broadcast when small, else spread.

    ``hot``: the fact's hot keys, if the caller counted them before other joins;
    ``small``: the outcome of the size check, if the caller made it.
    """
    if fits(dim, max_broadcast_rows) if small is None else small:
        return fact.join(F.broadcast(dim), on, how)
    hot = hot if hot is not None else hot_keys(fact, on, hot_key_rows, max_hot_keys)
    d = dim.withColumnRenamed(on, "_d_key")
    out = spread_join(fact, d, on, "_d_key", hot, None, how, salt_buckets)
    return out.select(on, *[c for c in out.columns if c != on])


def as_of_join(
    fact: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    start: str = "effective_start",
    end: str = "effective_end",
    how: str = "left",
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
    max_hot_keys: int = DEFAULT_MAX_HOT_KEYS,
    hot: DataFrame | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Attach the version valid at ``fact[at]``: ``start <= at`` and (``end`` NULL or ``at <= end``).

    ``versions`` holds ``key``, ``start``, ``end`` and the columns to attach.
    With non-overlapping versions each fact row matches at most one version,
    so the fact grain is kept.  The version columns other than ``key`` are
    returned next to the fact columns.  ``hot``, ``small``: see ``lookup_join``.
    """
    v = versions.withColumnRenamed(key, "_v_key")
    in_range = (F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) <= F.col(end)))
    if fits(versions, max_broadcast_rows) if small is None else small:
        return fact.join(F.broadcast(v), (F.col(key) == F.col("_v_key")) & in_range, how).drop("_v_key")
    hot = hot if hot is not None else hot_keys(fact, key, hot_key_rows, max_hot_keys)
    return spread_join(fact, v, key, "_v_key", hot, in_range, how, salt_buckets)

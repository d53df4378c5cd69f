"""Type-1 dimension maintenance (overwrite in place, no history).

An image is a DataFrame; the operators return the next image and never
mutate storage, so a failed or repeated run cannot leave a half-applied
merge behind.  The caller writes the result to a fresh location.

Merge rules, per natural key:

* in the image and the source, hashes differ -> tracked attributes, hash and
  ``updated_at`` come from the source; the surrogate key and untracked
  attributes stay;
* in the image and the source, hashes equal -> unchanged;
* only in the source -> inserted with the next dense key;
* only in the image -> kept (the source never deletes).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.functions.hashing import record_hash
from paymart.operators.keys import dense_keys, max_key
from paymart.sources.bronze import load_stamp

Stage = Callable[[DataFrame], DataFrame]


def with_record_hash(df: DataFrame, tracked: Sequence[str], null_safe: bool = False) -> DataFrame:
    return df.withColumn("record_hash", record_hash(list(tracked), null_safe=null_safe))


def scd1_initial(
    src: DataFrame,
    natural_key: str,
    key_col: str,
    tracked: Sequence[str],
    columns: Sequence[str],
    as_of: str,
    null_safe: bool = False,
    offset: int | None = None,
    rows_known: int | None = None,
) -> DataFrame:
    """First image: every source row, its hash, a dense key and the load stamp.

    ``offset``: the key to start after; ``rows_known``: a known bound on the source rows (see ``dense_keys``).
    """
    h = with_record_hash(src, tracked, null_safe).withColumn("updated_at", F.lit(load_stamp(as_of)))
    return dense_keys(h, natural_key, key_col, offset, rows=rows_known).select(*columns)


def scd1_merge(
    old: DataFrame,
    src: DataFrame,
    natural_key: str,
    key_col: str,
    tracked: Sequence[str],
    columns: Sequence[str],
    as_of: str,
    stage: Stage | None = None,
    null_safe: bool = False,
    offset: int | None = None,
    rows_known: int | None = None,
) -> DataFrame:
    """Next image after upserting ``src`` into ``old`` (see module rules).

    One full outer join yields every row of the next image, inserts without a
    key.  They are read three times (kept rows, key counts, numbering);
    ``stage`` may materialise them once (write and re-read, or persist).
    ``offset``: the key to start after, if the caller knows it (default: the
    largest of ``old``); ``rows_known``: a known bound on the source rows.
    """
    value_cols = [c for c in columns if c != key_col]
    s = with_record_hash(src, tracked, null_safe).withColumn("updated_at", F.lit(load_stamp(as_of)))
    s = s.select(*[F.col(c).alias(f"_s_{c}") for c in value_cols])
    j = old.select(*columns).join(s, F.col(natural_key) == F.col(f"_s_{natural_key}"), "full_outer")
    fresh = F.col(natural_key).isNull()
    changed = F.col(f"_s_{natural_key}").isNotNull() & ~F.col("record_hash").eqNullSafe(F.col("_s_record_hash"))
    updated = set(tracked) | {"record_hash", "updated_at"}
    rows = j.select(
        key_col,
        *[F.when(fresh | changed if c in updated else fresh, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) for c in value_cols],
    )
    if stage is not None:
        rows = stage(rows)
    inserts = rows.filter(F.col(key_col).isNull()).drop(key_col)
    inserts = dense_keys(inserts, natural_key, key_col, offset=max_key(old, key_col) if offset is None else offset, rows=rows_known).select(*columns)
    return rows.filter(F.col(key_col).isNotNull()).select(*columns).unionByName(inserts)

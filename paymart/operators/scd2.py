"""Type-2 dimension maintenance (versioned history).

Versions carry ``effective_start``, ``effective_end`` (NULL while open) and
``is_current``.  ``scd2_merge`` computes the whole next image from one
pinned old image and the source:

* history rows (``is_current = 0``) pass through untouched;
* current rows are full-outer joined to the source on the natural key once,
  and every joined row emits one or two rows from an array of structs:

  - ``new``        (source only)          -> a version starting at the first-seen date
  - ``missing``    (image only)           -> kept as is (the source never deletes)
  - ``unchanged``  (hash equal)           -> kept as is
  - ``changed``                           -> old version closed at ``as_of - 1``
                                             plus a new version from ``as_of``
  - ``changed`` with ``effective_start >= as_of`` (a same-day change) -> the
    version is replaced in place (same key and start), so no version ever
    ends before it starts;

* new versions get dense keys after the image's largest key.

First-seen start: ``initial_start="created_date"`` (default) opens a
customer's first version at its creation date (``as_of`` if NULL), so facts
dated before the load still find a version; ``"as_of"`` opens it at the load
day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.operators.keys import dense_keys, max_key
from paymart.operators.scd1 import Stage, with_record_hash

VERSION_COLUMNS = ["effective_start", "effective_end", "is_current"]


def _first_start(initial_start: str, as_of: str) -> Column:
    day = F.to_date(F.lit(as_of))
    if initial_start == "as_of":
        return day
    return F.coalesce(F.col(initial_start).cast("date"), day)


def scd2_initial(
    src: DataFrame,
    natural_key: str,
    key_col: str,
    tracked: Sequence[str],
    columns: Sequence[str],
    as_of: str,
    initial_start: str = "created_date",
    null_safe: bool = False,
    offset: int | None = None,
    rows_known: int | None = None,
) -> DataFrame:
    """First image: one open, current version per source row (``offset``, ``rows_known``: see ``scd1_initial``)."""
    h = (
        with_record_hash(src, tracked, null_safe)
        .withColumn("effective_start", _first_start(initial_start, as_of))
        .withColumn("effective_end", F.lit(None).cast("date"))
        .withColumn("is_current", F.lit(1))
    )
    return dense_keys(h, natural_key, key_col, offset, rows=rows_known).select(*columns)


def _joined(image: DataFrame, src: DataFrame, natural_key: str, tracked: Sequence[str], columns: Sequence[str], as_of: str, null_safe: bool = False):
    value_cols = [c for c in columns if c not in VERSION_COLUMNS]
    src_cols = [c for c in value_cols if c in src.columns or c == "record_hash"]
    s = with_record_hash(src, tracked, null_safe).select(*src_cols)
    sp = s.select(*[F.col(c).alias(f"_s_{c}") for c in src_cols])
    cur = image.filter(F.col("is_current") == 1).select(*columns)
    j = cur.join(sp, F.col(natural_key) == F.col(f"_s_{natural_key}"), "full_outer")
    in_t = F.col(natural_key).isNotNull()
    in_s = F.col(f"_s_{natural_key}").isNotNull()
    cls = (
        F.when(~in_t, F.lit("new"))
        .when(~in_s, F.lit("missing"))
        .when(F.col("record_hash").eqNullSafe(F.col("_s_record_hash")), F.lit("unchanged"))
        .otherwise(F.lit("changed"))
    )
    in_place = F.col("effective_start") >= F.to_date(F.lit(as_of))
    return j.withColumn("_class", cls).withColumn("_in_place", cls.eqNullSafe("changed") & in_place), src_cols


def scd2_classify(image: DataFrame, src: DataFrame, natural_key: str, tracked: Sequence[str], columns: Sequence[str], as_of: str) -> DataFrame:
    """Natural key and its class: new, changed, unchanged or missing (from the source)."""
    j, _ = _joined(image, src, natural_key, tracked, columns, as_of)
    return j.select(F.coalesce(F.col(natural_key), F.col(f"_s_{natural_key}")).alias(natural_key), F.col("_class").alias("change_class"))


def scd2_source_rows(image: DataFrame, src: DataFrame, natural_key: str, tracked: Sequence[str], columns: Sequence[str], as_of: str, change_class: str) -> DataFrame:
    """Source rows (with their hash) of one class: ``changed`` or ``new``."""
    j, src_cols = _joined(image, src, natural_key, tracked, columns, as_of)
    return j.filter(F.col("_class") == change_class).select(*[F.col(f"_s_{c}").alias(c) for c in src_cols])


def _emitted(image, src, natural_key, key_col, tracked, columns, as_of, initial_start, null_safe=False):
    """Rows emitted by the current-vs-source join, tagged by ``_kind``.

    Kinds: ``keep`` (unchanged/missing), ``expired``, ``replaced`` (same-day
    change, keeps its key), ``insert`` (needs a key).
    """
    j, src_cols = _joined(image, src, natural_key, tracked, columns, as_of, null_safe)
    day = F.to_date(F.lit(as_of))
    types = dict(image.select(*columns).dtypes)

    def from_target(end: Column, current: Column, kind: str) -> Column:
        fields = []
        for c in columns:
            v = end if c == "effective_end" else current if c == "is_current" else F.col(c)
            fields.append(v.cast(types[c]).alias(c))
        return F.struct(*fields, F.lit(kind).alias("_kind"))

    def from_source(key: Column, start: Column, kind: str) -> Column:
        fields = []
        for c in columns:
            if c == key_col:
                v = key
            elif c == "effective_start":
                v = start
            elif c == "effective_end":
                v = F.lit(None)
            elif c == "is_current":
                v = F.lit(1)
            else:
                v = F.col(f"_s_{c}") if c in src_cols else F.col(c)
            fields.append(v.cast(types[c]).alias(c))
        return F.struct(*fields, F.lit(kind).alias("_kind"))

    cls = F.col("_class")
    first_seen = day if initial_start == "as_of" else F.coalesce(F.col(f"_s_{initial_start}").cast("date"), day)
    first = (
        F.when(cls == "new", from_source(F.lit(None), first_seen, "insert"))
        .when(F.col("_in_place"), from_source(F.col(key_col), F.col("effective_start"), "replaced"))
        .when(cls == "changed", from_target(F.date_sub(day, 1), F.lit(0), "expired"))
        .otherwise(from_target(F.col("effective_end"), F.col("is_current"), "keep"))
    )
    second = F.when((cls == "changed") & ~F.col("_in_place"), from_source(F.lit(None), day, "insert"))
    rows = j.select(F.inline(F.filter(F.array(first, second), lambda x: x.isNotNull())))
    return rows


def scd2_expire(image, src, natural_key, key_col, tracked, columns, as_of, initial_start="created_date") -> DataFrame:
    """The versions closed by this load (``is_current = 0``, end ``as_of - 1``)."""
    rows = _emitted(image, src, natural_key, key_col, tracked, columns, as_of, initial_start)
    return rows.filter(F.col("_kind") == "expired").select(*columns)


def scd2_inserts(image, src, natural_key, key_col, tracked, columns, as_of, initial_start="created_date") -> DataFrame:
    """New versions (changed and new customers) with their new dense keys."""
    rows = _emitted(image, src, natural_key, key_col, tracked, columns, as_of, initial_start)
    fresh = rows.filter(F.col("_kind") == "insert").drop(key_col, "_kind")
    return dense_keys(fresh, natural_key, key_col, offset=max_key(image, key_col)).select(*columns)


def scd2_step(
    current: DataFrame, src: DataFrame, natural_key, key_col, tracked, columns, as_of, initial_start="created_date",
    stage: Stage | None = None, null_safe: bool = False, offset: int | None = None, rows_known: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(next current versions, versions this load closes), from the current versions alone.

    Closed history is neither read nor rewritten, so the cost follows the
    current versions, not the history.  The largest key always belongs to a
    current version (a closed one is followed by a newer one with a larger
    key), so numbering goes on without the history too.  The emitted rows feed
    four consumers; ``stage`` may materialise them once (write and re-read, or
    persist).  ``offset``: the key to start after, if the caller knows it;
    ``rows_known``: a known bound on the source rows.
    """
    rows = _emitted(current, src, natural_key, key_col, tracked, columns, as_of, initial_start, null_safe)
    if stage is not None:
        rows = stage(rows)
    kind = F.col("_kind")
    fresh = rows.filter(kind == "insert").drop(key_col, "_kind")
    inserts = dense_keys(fresh, natural_key, key_col, offset=max_key(current, key_col) if offset is None else offset, rows=rows_known).select(*columns)
    stay = rows.filter(kind.isin("keep", "replaced")).select(*columns).unionByName(inserts)
    return stay, rows.filter(kind == "expired").select(*columns)


def scd2_merge(
    image, src, natural_key, key_col, tracked, columns, as_of, initial_start="created_date", stage: Stage | None = None, null_safe: bool = False
) -> DataFrame:
    """The next image: history + kept/expired/replaced rows + keyed inserts (see ``scd2_step``)."""
    current = image.filter(F.col("is_current") == 1)
    stay, closed = scd2_step(current, src, natural_key, key_col, tracked, columns, as_of, initial_start, stage, null_safe)
    history = image.filter(F.col("is_current") == 0).select(*columns)
    return history.unionByName(closed).unionByName(stay)


def scd2_counts(image: DataFrame) -> DataFrame:
    """Total, current and historical version counts in one aggregate."""
    cur = F.col("is_current") == 1
    return image.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
        F.count(F.when(cur, F.lit(1))).cast("bigint").alias("current_rows"),
        F.count(F.when(~cur, F.lit(1))).cast("bigint").alias("historical_rows"),
    )

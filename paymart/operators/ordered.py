"""Carrying rows forward along a global order, without a task that holds a whole key.

``ordered_parts`` range-partitions rows by a total order and writes them with the
number of their part.  A window by part number then sees a contiguous run of the
order, and what reaches over the border of a part is looked up in a table with one
row a part: the last carried row of the parts before it.  A key with a third of all
rows is cut into as many parts as its rows fill.

The parts are written because two steps read them: range bounds come from a sample,
so a frame made twice could be cut at other rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paymart.sources.storage import new_table_path, read_table, write_table


def ordered_parts(df: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """``df`` with a column ``_part``: parts ascend along ``order``; written once."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    return read_table(spark, write_table(out, new_table_path(spark, "ordered")), out.schema)


def carried_in(parted: DataFrame, order: list[str], carried: str) -> DataFrame:
    """(_part, _in): the last non-null ``carried`` of all parts before each part.

    One row a part, so the single-task window runs over at most the number of partitions.
    """
    last = F.max_by(carried, F.when(F.col(carried).isNotNull(), F.struct(*order)))
    ends = parted.groupBy("_part").agg(last.alias("_last"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return ends.select("_part", F.last("_last", ignorenulls=True).over(before).alias("_in"))


def carry_forward(parted: DataFrame, order: list[str], carried: str, include_own: bool = True) -> DataFrame:
    """``parted`` with ``_carried``: the last non-null ``carried`` at or before each row (``include_own`` False: before it)."""
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if include_own else -1)
    ends = carried_in(parted, order, carried)
    rows = parted.withColumn("_inside", F.last(carried, ignorenulls=True).over(inside))
    return rows.join(F.broadcast(ends), "_part", "left").withColumn("_carried", F.coalesce("_inside", "_in")).drop("_inside", "_in")


def as_of_join_ordered(
    fact: DataFrame, versions: DataFrame, key: str, at: str, start: str = "effective_start", end: str = "effective_end", parts: int | None = None
) -> DataFrame:
    """``as_of_join`` (left) by one ordered stream of versions and facts, for two large sides.

    Facts and versions are ordered by (key, date, versions first, row hash); each fact takes the last
    version before it, if that has its key and has not ended.  Nothing is broadcast but one row a
    part, no version is replicated and no key is counted beforehand.  As in ``as_of_join`` versions
    of a key must not overlap.  Facts with a NULL key or date match nothing and stay out of the
    order; versions with a NULL key or start match nothing.  Equal facts stay as many rows as they are.
    """
    columns = [c for c in versions.columns if c != key]
    version_type = versions.select(F.struct(*versions.columns).alias("v")).schema["v"].dataType
    fact_type = fact.select(F.struct(*fact.columns).alias("f")).schema["f"].dataType
    placed = F.col(key).isNotNull() & F.col(at).isNotNull()
    rows = fact.where(placed).select(
        F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.xxhash64(*fact.columns).alias("_hash"),
        F.struct(*fact.columns).alias("_fact"), F.lit(None).cast(version_type).alias("_version"))
    starts = versions.where(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key).alias("_key"), F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.xxhash64(*versions.columns).alias("_hash"),
        F.lit(None).cast(fact_type).alias("_fact"), F.struct(*versions.columns).alias("_version"))
    order = ["_key", "_at", "_kind", "_hash"]
    found = carry_forward(ordered_parts(rows.unionByName(starts), order, parts), order, "_version").where("_kind = 1")
    v = F.col("_carried")
    valid = (v[key] == F.col("_key")) & (v[end].isNull() | (F.col("_at") <= v[end]))
    matched = found.select("_fact.*", *[F.when(valid, v[c]).alias(c) for c in columns])
    # NOT (a AND b) is never NULL here: both are IS NOT NULL tests
    unplaced = fact.where(~placed).select(*fact.columns, *[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in columns])
    return matched.unionByName(unplaced)


def interval_audit(
    versions: DataFrame, key: str, surrogate: str, start: str = "effective_start", end: str = "effective_end", current: str = "is_current",
    parts: int | None = None,
) -> DataFrame:
    """One row per version with a fault, and its neighbour before: (key, surrogate, start, end, previous end, fault).

    Faults: ``overlap`` (starts at or before the end of the one before, which may be open), ``gap`` (starts
    later than the day after it), ``key_order`` (a smaller or equal surrogate key than the one before),
    ``reversed`` (ends before it starts) and ``open_flag`` (open but not current, or current but closed).
    A version may have several faults, one row each.  Versions are compared along one order by (id, start,
    surrogate key), so an id with many versions is cut over several tasks.  NULL ids have no history: only
    the last two faults are looked for.
    """
    row = F.struct(F.col(key).alias("k"), F.col(surrogate).alias("s"), F.col(end).alias("e"))
    order = [key, start, surrogate, end, current]
    parted = ordered_parts(versions.select(key, surrogate, start, end, current).withColumn("_row", row), order, parts)
    rows, before = carry_forward(parted, order, "_row", include_own=False), F.col("_carried")
    follows = before["k"] == F.col(key)
    faults = {
        "overlap": follows & (before["e"].isNull() | (F.col(start) <= before["e"])),
        "gap": follows & (F.col(start) > F.date_add(before["e"], 1)),
        "key_order": follows & (F.col(surrogate) <= before["s"]),
        "reversed": F.col(end) < F.col(start),
        "open_flag": F.col(end).isNull() != (F.col(current) == 1),
    }
    found = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in faults.items()]))
    return rows.select(key, surrogate, start, end, F.when(follows, before["e"]).alias("previous_end"), F.explode(found).alias("fault"))

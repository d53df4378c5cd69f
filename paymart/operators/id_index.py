"""Which ids are stored already: Bloom filters by hash bucket, kept beside a table.

A day's filters are rows (buckets, bucket, bits): an id falls into one of
``buckets`` buckets by its hash and sets ``HASHES`` bits of the bucket's 32,768
(``bitmap_construct_agg``).  With ``IDS_PER_BUCKET`` ids a bucket under one id in
a hundred that is not there is admitted, at about 1.4 bytes an id.

Filters are built from one long an id, which holds its bucket and its bit positions:
the longs are shuffled and sorted by bucket, and bits are spread out only on the
way into the bitmaps.  Bitmaps made before a shuffle would be nearly empty where
there are many buckets, and so larger than the ids.

``admitted`` meets new ids with the filters of earlier days: a join on the
bucket and bit tests, all built-in expressions.  Filters are broadcast behind the
size check, so that ids are shuffled to them only where there are some 60,000
buckets.  Only ids that a filter admits have to be looked up in the stored column;
a day whose filters admit none is not read at all.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.operators.joins import checked_broadcast

BITS = 32_768  # positions of one bitmap
BIT_WIDTH = 15
HASHES = 4
IDS_PER_BUCKET = 3_000
FILTER_SCHEMA = "buckets long, bucket long, bits binary"


def bucket_count(rows: int) -> int:
    """Buckets of a day: a power of two, so that many days share few bucket counts."""
    buckets = 1
    while buckets * IDS_PER_BUCKET < rows:
        buckets *= 2
    return buckets


def _hash(id_col: str) -> Column:
    return F.xxhash64(F.col(id_col))


def _steps(id_col: str) -> Column:
    """The first position of an id and the step to the next, in one long."""
    first, step = F.xxhash64(F.lit(1), F.col(id_col)), F.xxhash64(F.lit(2), F.col(id_col))
    return F.pmod(first, F.lit(BITS)) * BITS + F.pmod(step, F.lit(BITS))


def _positions(steps: Column) -> list[Column]:
    first, step = F.pmod(F.shiftright(steps, BIT_WIDTH), F.lit(BITS)), F.pmod(steps, F.lit(BITS))
    return [F.pmod(first + k * step, F.lit(BITS)) for k in range(HASHES)]


def id_filters(ids: DataFrame, id_col: str, buckets: int) -> DataFrame:
    """(buckets, bucket, bits) of the ids; NULL ids set nothing."""
    places = ids.where(F.col(id_col).isNotNull()).select((F.pmod(_hash(id_col), F.lit(buckets)) * BITS * BITS + _steps(id_col)).alias("place"))
    places = places.repartition(F.shiftright("place", 2 * BIT_WIDTH)).select(F.shiftright("place", 2 * BIT_WIDTH).alias("bucket"), "place").sortWithinPartitions("bucket")
    rows = places.select("bucket", F.explode(F.array(*_positions(F.col("place")))).alias("at"))
    return rows.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).select(F.lit(buckets).cast("long").alias("buckets"), "bucket", "bits")


def admitted(ids: DataFrame, id_col: str, filters: DataFrame, counts: list[int]) -> DataFrame:
    """(``id_col``, ``of``) of the ids that a filter admits; ``filters`` carry ``of``, the day they belong to.

    ``counts``: the bucket counts that occur in ``filters`` (powers of two, so at most some dozens).
    """
    keyed = ids.where(F.col(id_col).isNotNull()).select(id_col, _steps(id_col).alias("_steps"), F.explode(F.array(*[F.lit(c).cast("long") for c in counts])).alias("buckets"))
    keyed = keyed.withColumn("bucket", F.pmod(_hash(id_col), F.col("buckets")))

    def is_set(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("bits"), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1

    every = functools.reduce(Column.__and__, [is_set(at) for at in _positions(F.col("_steps"))])
    return keyed.join(checked_broadcast(filters), ["buckets", "bucket"]).where(every).select(id_col, "of")

"""Uniform shuffle into shards of exact size (operator 8), after the law ``rows``.

Rows fall into P logical parts by a keyed hash of their key columns and their
number among equal rows (so that these spread as well).  Part sizes are counted, and one matrix of
part-to-shard counts is drawn from the multivariate hypergeometric law that a
uniform shuffle into shards of fixed sizes follows (P x shards numbers, whatever
the number of rows).  Each part is permuted by a keyed hash and cut at its row
of the matrix; the rows of a shard are permuted again by a second keyed hash.
Shard sizes are exact: at most one row apart.

No task holds a whole shard: a shard's order is cut into P ranges of the second
hash, and a row's slot is the count of all lower ranges plus its rank in its own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paymart.llm.common import numbered_copies, shuffle_partitions, staged

SHARDS = 40
SEED = 20240607


def communication_matrix(parts: np.ndarray, shards: np.ndarray, seed: int) -> np.ndarray:
    """How many rows each part sends to each shard: rows sum to ``parts``, columns to ``shards``."""
    random = np.random.default_rng(seed)
    left = shards.astype(np.int64).copy()
    out = np.zeros((len(parts), len(shards)), np.int64)
    for i, n in enumerate(parts.tolist()):
        out[i] = _draw(random, left, n)
        left -= out[i]
    return out


def _draw(random: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """One multivariate hypergeometric draw, a count at a time."""
    out, rest = np.zeros(len(left), np.int64), int(left.sum())
    for k, size in enumerate(left.tolist()):
        out[k] = _hypergeometric(random, size, rest - size, n)
        n, rest = n - int(out[k]), rest - size
    return out


def _hypergeometric(random: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` rows drawn from good + bad are good, at any size: inversion over the weights around the mode.

    Weights come from the ratios of neighbours; beyond 12 deviations (and 64) they are under 1e-18 of the mode's.
    """
    low, high, total = max(0, n - bad), min(n, good), good + bad
    if low == high:
        return low
    mode = min(max((n + 1) * (good + 1) // (total + 2), low), high)
    reach = 64 + int(12 * np.sqrt(n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1))))
    up = np.arange(mode, min(high, mode + reach), dtype=float)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=float)
    more = np.cumprod((good - up) / (up + 1) * ((n - up) / (bad - n + up + 1)))
    less = np.cumprod(down / (good - down + 1) * ((bad - n + down) / (n - down + 1)))
    upto = np.cumsum(np.concatenate((less[::-1], [1.0], more)))
    at = int(np.searchsorted(upto, random.random() * upto[-1], side="right"))
    return mode - len(less) + min(at, len(upto) - 1)


def _high_bits(hashed: Column, parts: int) -> Column:
    """Range number 0 .. parts - 1 of a signed 64-bit hash, in the order of the hash."""
    return F.least(F.floor((F.shiftright(hashed, 32) + F.lit(1 << 31)) * parts / F.lit(1 << 32)).cast("int"), F.lit(parts - 1))


def uniform_shards(rows: DataFrame, key: list[str], shards: int = SHARDS, seed: int = SEED, parts: int | None = None) -> DataFrame:
    """``rows`` with shard (0 .. shards - 1) and slot (gapless from 0 in each shard) added.

    ``key`` columns tell rows apart; rows equal in all of them are interchangeable, and any number of
    them (and nulls) is fine.  The result repeats for the same rows, seed and ``parts`` (by default from
    the session's shuffle partitions), however the input is split.  An empty table stays empty.
    ``shard`` and ``slot`` replace columns of these names, other names are free.
    """
    spark = rows.sparkSession
    parts = parts or max(8, 2 * shuffle_partitions(spark))
    bare = rows.drop("shard", "slot").select(
        F.struct(*[F.col(f"`{c}`") for c in rows.drop("shard", "slot").columns]).alias("row"), F.xxhash64(*[F.col(f"`{k}`") for k in key]).alias("same")
    )
    copies, _ = numbered_copies(bare, F.col("same"), "copy", "shuffle")
    first = copies.select("row", F.xxhash64("same", "copy", F.lit(seed)).alias("first"))
    hashed = staged(first.withColumn("part", _high_bits(F.col("first"), parts)), "parts")
    sizes = np.zeros(parts, np.int64)
    for r in hashed.groupBy("part").count().collect():  # one row a part
        sizes[r["part"]] = r["count"]
    total = int(sizes.sum())
    wanted = np.full(shards, total // shards) + (np.arange(shards) < total % shards)
    ends = np.cumsum(communication_matrix(sizes, wanted, seed), axis=1)
    plan = spark.createDataFrame([(i, e.tolist()) for i, e in enumerate(ends)], "part int, ends array<long>")

    ranked = hashed.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy("first")).cast("long"))
    # a row goes to the first shard whose cumulative count reaches its rank
    dealt = (
        ranked.join(F.broadcast(plan), "part")
        .select("row", F.size(F.filter("ends", lambda e: e < F.col("rank"))).cast("int").alias("shard"), F.xxhash64("first", F.lit(seed + 1)).alias("second"))
        .withColumn("part", _high_bits(F.col("second"), parts))
    )
    dealt = staged(dealt, "dealt")
    counts = dealt.groupBy("shard", "part").count()  # shards x parts rows
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("shard", "part").orderBy("second"))
    return dealt.withColumn("rank", rank).join(F.broadcast(starts), ["shard", "part"]).select(
        "row.*", "shard", (F.col("start") + F.col("rank") - 1).cast("long").alias("slot")
    )

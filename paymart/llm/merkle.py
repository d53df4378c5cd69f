"""Merkle manifest of a dataset by lag and lead windows (operator 13).

Every row is a leaf.  Leaves of one group (``source``) stand in order of their
id; every 16 consecutive nodes become one parent until one node, the group's
subroot, is left.  Subroots in order of the group likewise become the root.

A level is one window over runs of 16: ``lead`` columns at the fixed offsets
1..15, masked by slot and run length, are the nodes that the run's first row
hashes into the parent; on the way down the same ``lead`` columns and their
``lag`` counterparts are a node's siblings, right and left.  Windows and joins
are dealt by (group, run), so a group that holds a third of all rows is spread
over as many tasks as any other rows.

Places within a group come from a range partitioning by (group, id, leaf), row
numbers within a partition and one count a partition and group; no task holds a
group and nothing but the size of the largest group reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paymart.llm.common import shuffle_partitions, staged

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: string, right: string>>"

_PART_BITS = 33  # monotonically_increasing_id: partition above, row number below


def leaf_hash(fields: Sequence[Column]) -> Column:
    """sha256 (lowercase hex) of the fields: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, at: F.sha2(F.concat(at["left"], node, at["right"]), 256))


def siblings(path: Column) -> Column:
    """All siblings of a path in one string, level by level, left to right."""
    return F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), "")


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0 within ``grp`` in the given order) and ``size`` (rows of the group).

    Equal rows are told apart by a running number, so that many of them are many ranges.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("grp", *order, "tie")]
    ranged = staged(
        rows.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
        .withColumn("at", F.monotonically_increasing_id()).drop("tie"),
        "merkle-ranged",
    ).withColumn("part", F.shiftright("at", _PART_BITS))
    counts = ranged.groupBy("grp", "part").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    group = Window.partitionBy("grp")
    before = F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("grp", "part", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("shift"), F.sum("n").over(group).alias("size"))
    return ranged.join(starts, ["grp", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _in_runs(nodes: DataFrame) -> tuple[DataFrame, list[Column], list[Column]]:
    """``nodes`` with their run, and the masked lag and lead columns, nearest first."""
    run = Window.partitionBy("grp", "run").orderBy("pos")
    slot = F.pmod("pos", F.lit(FANOUT))
    length = F.least(F.lit(FANOUT), F.col("size") - F.col("run") * FANOUT)
    none = F.lit("")
    lags = [F.when(slot >= k, F.lag("node", k).over(run)).otherwise(none) for k in range(1, FANOUT)]
    leads = [F.when(slot + k < length, F.lead("node", k).over(run)).otherwise(none) for k in range(1, FANOUT)]
    return nodes.withColumn("run", F.floor(F.col("pos") / FANOUT)), lags, leads


def _parents(nodes: DataFrame) -> DataFrame:
    """The next level of all groups that still have several nodes: the first row of each run hashes the run."""
    rows, _, leads = _in_runs(nodes.select("grp", "pos", "size", "node").where("size > 1"))
    return (
        rows.withColumn("parent", F.sha2(F.concat("node", *leads), 256))
        .where(F.pmod("pos", F.lit(FANOUT)) == 0)
        .select("grp", F.col("run").alias("pos"), F.ceil(F.col("size") / FANOUT).alias("size"), F.col("parent").alias("node"))
    )


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """All levels, leaves first; a group ends at the level where its size is 1."""
    most = leaves.agg(F.max("size")).first()[0] or 1
    levels = [leaves]
    while most > 1:
        levels.append(staged(_parents(levels[-1]), "merkle-level"))
        most = -(-most // FANOUT)
    return levels


def _paths(levels: list[DataFrame], ends: DataFrame) -> DataFrame:
    """The leaves with the columns of ``ends`` (grp, path, ...) and ``path``: their siblings, then those of each ancestor, then the end's."""
    carried = [c for c in ends.columns if c not in ("grp", "path")]
    below: DataFrame | None = None
    for depth in reversed(range(len(levels))):
        nodes = levels[depth]
        kept = [c for c in nodes.columns if c != "size"]
        found = nodes.where("size = 1").join(ends, "grp").select(*kept, "path", *carried)
        if below is not None:
            rows, lags, leads = _in_runs(nodes.where("size > 1"))
            above = below.select("grp", F.col("pos").alias("run"), F.col("path").alias("above"), *carried)
            here = F.struct(F.concat(*reversed(lags)).alias("left"), F.concat(*leads).alias("right"))
            found = found.unionByName(
                rows.join(above, ["grp", "run"]).withColumn("path", F.concat(F.array(here), "above")).select(*kept, "path", *carried)
            )
        below = staged(found, "merkle-paths") if depth else found
    return below


def _ends(levels: list[DataFrame]) -> DataFrame:
    """(grp, node) where each group ends."""
    out = None
    for nodes in levels:
        one = nodes.where("size = 1").select("grp", "node")
        out = one if out is None else out.union(one)
    return out


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source", also: Column | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, path (and ``also``, a column of ``docs``).

    ``path`` holds for each level from the leaf up the siblings left and right of the node, as
    concatenated digests; ``fold(leaf, path)`` is the root.  A node without siblings has two empty
    strings there; a level that a group does not have is not in the path.

    Nulls are hashed as ``-``; a null id comes first in its group, a null group first of all and apart
    from the empty one.  Rows of one id stand in order of their leaf; equal rows are leaves of their own,
    and which of them comes first cannot be told from the result.  One row alone is leaf, subroot and
    root.  An empty table gives no rows.  Columns outside ``fields`` take no part, whatever their names.
    """
    group = F.col(group_col).cast("string")
    leaves = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group)).alias("grp"),
            leaf_hash([F.col(c) for c in fields]).alias("node"),
            (also if also is not None else F.lit(None).cast("string")).alias("also"),
        ),
        "merkle-leaves",
    )
    levels = _levels(staged(_placed(leaves, ["doc_id", "node"]), "merkle-placed"))
    subroots = staged(_ends(levels), "merkle-subroots")
    top = _levels(_placed(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("of"), "node"), ["of"]))
    root = _ends(top).select("grp", F.array().cast(PATH).alias("path"), F.col("node").alias("root"))
    ends = staged(
        _paths(top, root).select(F.col("of").alias("grp"), "path", F.col("node").alias("subroot"), "root"), "merkle-top"
    )
    out = _paths(levels, ends).select("doc_id", F.col("node").alias("leaf"), "subroot", "root", "path", "also")
    return out if also is not None else out.drop("also")


def digests(docs: DataFrame) -> DataFrame:
    """The manifest checked against rows of which some were changed: where 5 divides the crc32 of the decimal
    doc_id, the text's A-Z were lowered.  Rows without an id are not changed."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = leaf_hash([F.translate(c, upper, upper.lower()) if c == "text" else F.col(c) for c in FIELDS])
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    found = manifest(docs, also=F.when(hit, changed))
    folded = fold(F.coalesce("also", "leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

"""Connected components of a link table, by repeated joins.

Each round gives every node the smallest label among its own and its
neighbours', then the label of that label (pointer jumping), so a component of
n nodes settles in O(log n) rounds.  Every round is written to the shared
folder; the driver sees one number a round, that of the labels that changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import staged


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): label is the smallest node that links reach.  Nodes without a link are left out.

    Loops, repeated links and either direction are fine; links with a null end are ignored; no links
    give an empty table.
    """
    one = links.select(F.col(a).alias("s"), F.col(b).alias("t")).where("s <> t")
    both = staged(one.union(one.select(F.col("t").alias("s"), F.col("s").alias("t"))).distinct(), "links")
    labels = staged(both.groupBy(F.col("s").alias("node")).agg(F.least(F.first("s"), F.min("t")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels, both["t"] == labels["node"])
            .groupBy("s").agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, labels["node"] == near["s"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        of = labels.select(F.col("node").alias("via"), F.col("label").alias("jump"))
        after = staged(
            lower.join(of, lower["low"] == of["via"]).select("node", "old", F.least("low", "jump").alias("label")),
            "labels",
        )
        changed = after.where("label <> old").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels

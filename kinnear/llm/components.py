"""Connected components of an undirected graph given as edges of long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinnear.llm.tables import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges(a, b)``; label: the smallest node reachable.

    Each round points every node to its least neighbour (or itself), follows
    the pointer's own pointer, and contracts the edges to what the nodes point
    to; edges inside a contracted node vanish, so the rounds shrink quickly.
    A hub's neighbours are pre-aggregated by the partial minimum; the joins are
    plain ones which adaptive execution may split at a hot node.  Every round
    is written to the shared folder, so a lost executor costs one round.  No
    edges: no rows.
    """
    left = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while True:
        both = left.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        near = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("near"))
        near = stage(near)
        far = near.select(F.col("node").alias("near"), F.col("near").alias("far"))
        to = stage(near.join(far, "near").select("node", F.col("far").alias("to")))
        if labels is None:
            labels = to.select("node", F.col("to").alias("label"))
        else:
            labels = stage(labels.join(to.withColumnRenamed("node", "label"), "label", "left").select(
                "node", F.coalesce("to", "label").alias("label")))
        left = stage(
            left.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
        if not left.limit(1).count():
            return labels

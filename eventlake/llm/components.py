"""Connected components of an edge table, by hooking to the smallest neighbour and relabelling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm._common import cut


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b longs) -> (id, component): the smallest id reachable, for every id in an edge.

    Each round every vertex takes its smallest neighbour (or itself) as its parent, parents are
    followed twice, and the edges are rewritten between the new labels; at least half of the
    non-minimal vertices vanish, so the number of rounds is logarithmic. Self loops and repeated
    edges are ignored, rows with a null end are dropped, and an empty table gives an empty one.
    """
    edges = cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    label = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("p"))
        for _ in range(2):
            up = parent.select(F.col("id").alias("p"), F.col("p").alias("pp"))
            parent = parent.join(up, "p").select("id", F.col("pp").alias("p"))
        parent = cut(parent, "cc-parent")
        if label is None:
            label = parent.select("id", F.col("p").alias("component"))
        else:
            label = label.join(parent.select(F.col("id").alias("component"), "p"), "component", "left").select("id", F.coalesce("p", "component").alias("component"))
        left = parent.select(F.col("id").alias("a"), F.col("p").alias("pa"))
        right = parent.select(F.col("id").alias("b"), F.col("p").alias("pb"))
        edges = edges.join(left, "a").join(right, "b").where("pa <> pb")
        edges = cut(edges.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "cc-edges")
        if edges.isEmpty():
            return label

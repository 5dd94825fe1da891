"""Connected components of a graph of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lymphlake.plans.tables import written


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) over undirected ``edges (a, b)``.

    Each round takes the smallest label of the neighbours and then of the
    label's own label, so long chains shrink fast; rounds are written to the
    shared folder. Only nodes with an edge are listed.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "graph-edges")
    label = written(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "graph-labels")
    while True:
        theirs = label.select(F.col("node").alias("b"), F.col("label").alias("theirs"))
        seen = both.join(theirs, "b").groupBy("a").agg(F.min("theirs").alias("theirs"))
        hooked = written(label.join(seen, F.col("node") == F.col("a"), "left").select("node", F.col("label").alias("was"), F.least("label", F.coalesce("theirs", "label")).alias("label")), "graph-hooked")
        jump = hooked.select(F.col("node").alias("via"), F.col("label").alias("further"))
        fresh = written(hooked.join(jump, F.col("label") == F.col("via"), "left").select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label")), "graph-labels")
        if not fresh.where(F.col("was") != F.col("label")).take(1):
            return fresh.select("node", F.col("label").alias("component"))
        label = fresh.select("node", "label")

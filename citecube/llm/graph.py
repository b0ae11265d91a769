"""Connected components by contraction, entirely in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of ``edges`` (columns a, b): component is
    the smallest id reachable.

    Each round hooks every node onto its smallest smaller neighbour, flattens
    the hooks by pointer jumping, and contracts the edges; only local minima
    survive a round.  Tables are written between steps, so a lost executor
    costs one step.  A hub of many edges is pre-aggregated in the hooking and
    split by AQE in the contraction, as both join inputs are plain scans."""
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .where("a < b").distinct(), "cc-edges")
    ids = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    labels = materialize(ids.select("id", F.col("id").alias("component")), "cc-labels")
    while not edges.isEmpty():
        hooks = materialize(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "cc-hooks")
        while True:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("above"))
            jumped = materialize(hooks.join(up, "root", "left")
                                 .select("node", F.coalesce("above", "root").alias("root"),
                                         F.col("above").isNotNull().alias("moved")), "cc-hooks")
            settled = jumped.where("moved").isEmpty()
            hooks = jumped.select("node", "root")
            if settled:
                break
        labels = materialize(labels.join(hooks, labels["component"] == hooks["node"], "left")
                             .select("id", F.coalesce("root", "component").alias("component")), "cc-labels")
        for end in ("a", "b"):
            edges = (edges.join(hooks, edges[end] == hooks["node"], "left")
                     .withColumn(end, F.coalesce("root", end)).select("a", "b"))
        edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                            .where("a < b").distinct(), "cc-edges")
    return labels

"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweft.operators.staging import write_stage


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, component) for each node of edges (a, b); a component is named by its smallest node.

    Every round takes the smallest name among a node and its neighbours, then the name of
    that name's node, so rounds grow with the logarithm of a component's breadth.  Each
    round is written to `folder`, in the shared scratch space.  Rows are narrow and
    aggregates combine first; joins on a hot node have one row on the other side, so
    Spark can split them.  Null nodes and loops are left out; no edges give no rows.
    """
    edges = edges.filter("a is not null and b is not null and a <> b").select("a", "b")
    both = write_stage(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", folder)
    names = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component"))
    names, n = write_stage(names, "names-0", folder), 0
    while True:
        n += 1
        near = both.join(names, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        step = names.join(near, F.col("node") == F.col("a")).select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = names.select(F.col("node").alias("component"), F.col("component").alias("further"))
        step = step.join(jump, "component").select("node", "old", F.least("component", "further").alias("component"))
        step = write_stage(step, f"names-{n}", folder)
        names = step.select("node", "component")
        if step.filter("old <> component").isEmpty():
            return names

"""Connected components of an undirected graph, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refgauge.workspace import written


def round_of(edges: DataFrame) -> DataFrame:
    """One round on (a, b) with a > b: every node keeps its least neighbour, the others hook to that
    one, and all edges go on to the least neighbour of their end. `changed`: something was done.

    Least neighbours come from partial aggregation, and the joins are on exchanges that adaptive
    execution splits, so a node that a third of all edges lead to does not end in one task.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hooks = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    now = least.select("a", F.col("m").alias("b"), F.lit(False).alias("changed")).unionByName(
        hooks.withColumn("changed", F.lit(True))
    )
    up = least.select(F.col("a").alias("b"), F.col("m").alias("up"))
    return now.join(up, "b", "left").select(
        "a", F.coalesce("up", "b").alias("b"), (F.col("changed") | F.col("up").isNotNull()).alias("changed")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; a component is named by its least node.

    edges: (a, b) of ids. Loops and rows with nulls are left out; repeated rows change nothing. Each
    round is written before it is read again; there are about as many as the logarithm of the
    longest path.
    """
    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(round_of(ordered), "edges")
    while now.filter("changed").head(1):
        now = written(round_of(now.select("a", "b")), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

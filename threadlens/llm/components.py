"""Connected components of an edge table, by contraction.

Every round each node hooks onto the neighbour (or itself) with the smallest
hash of the round; edges and labels move to the hooks, and edges inside a node
vanish.  The number of nodes with edges falls by a constant factor a round,
whatever the shape.  A node's neighbours are only ever aggregated (combined
before the shuffle), never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, component) of every node with an edge; component is the smallest node in it."""
    spark = edges.sparkSession
    edges = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = nodes.select("node", F.col("node").alias("label"))
    turn = 0
    while not edges.isEmpty():
        turn += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("v"))  # noqa: E731, B023
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min(rank("b")).alias("near")).select(
            F.col("a").alias("from"), F.least(F.col("near"), rank("a"))["v"].alias("to"))
        hooks = written(hooks, "hooks")
        # one jump along the hooks: nodes move to where their hook moves
        jump = hooks.alias("h").join(hooks.alias("g"), F.col("h.to") == F.col("g.from")).select(F.col("h.from").alias("from"), F.col("g.to").alias("to"))
        jump = written(jump, "jump")
        moved = edges.join(jump.toDF("a", "ta"), "a").join(jump.toDF("b", "tb"), "b").where("ta <> tb")
        edges = written(moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
        labels = written(labels.join(jump.toDF("label", "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
    small = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(small, "label").select("node", "component") if turn else spark.createDataFrame([], "node long, component long")

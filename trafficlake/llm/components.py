"""Connected components of an edge table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.frames import cut


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of the undirected ``edges`` (a, b); the root is the smallest id of the component.

    Every round takes the smallest label among the neighbours, then that label's own label, so chains halve. Labels
    are combined before each shuffle, joins may be split where a hub is skewed, and each round is a checkpoint in the
    shared folder. Only the number of changed labels reaches the driver. Self loops give components of one node.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a").toDF("a", "b")).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("root")))
    while True:
        lowest = (
            both.join(labels.select(F.col("id").alias("b"), "root"), "b")
            .groupBy("a")
            .agg(F.min("root").alias("m"))
            .select(F.col("a").alias("id"), "m")
        )
        near = labels.join(lowest, "id").select("id", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        jump = labels.select(F.col("id").alias("root"), F.col("root").alias("up"))
        after = cut(near.join(jump, "root").select("id", "old", F.least("root", "up").alias("root")))
        labels = after.select("id", "root")
        if not after.where("old <> root").limit(1).count():
            return labels

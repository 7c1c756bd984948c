"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.session import materialize


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, comp) of every node of ``edges`` (u, v): the least node that it is connected to.

    Every round each node takes the least label among its neighbours and then the label of that label, so that long
    chains shrink by doubling; rounds end when nothing changes. Each round is a written table; a node with very many
    neighbours is summed before it is shuffled. Nothing but a count reaches the driver.
    """
    both = materialize(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
                       .where("u <> v").distinct(), f"{name}-edges")
    labels = materialize(both.groupBy(F.col("u").alias("node"))
                         .agg(F.least(F.min("v"), F.min("u")).alias("comp")), f"{name}-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "n"), F.col("v") == F.col("n"))
                .groupBy("u").agg(F.min("comp").alias("least")))
        hop = (labels.join(near, F.col("node") == F.col("u"), "left")
               .select("node", F.col("comp").alias("old"), F.least("comp", "least").alias("mid")))
        jump = labels.select(F.col("node").alias("j"), F.col("comp").alias("far"))
        after = materialize(hop.join(jump, F.col("mid") == F.col("j"), "left")
                            .select("node", F.least("mid", "far").alias("comp"), "old"), f"{name}-labels")
        labels = after.select("node", "comp")
        if after.where("comp <> old").isEmpty():
            return labels

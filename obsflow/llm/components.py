"""Connected components of an undirected graph by joins: smallest label, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.staging import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(src, dst)``; component is its smallest node.

    Each round gives a node the smallest label among its neighbours' and its label's, which is never above its own, so that
    long chains halve. The label counts as one more neighbour, so one join finds both, and brings the node's own label along: it ends when none has moved. The many small joins are
    merge joins: a broadcast for each would fill the driver. So would a sum after each round, as every shuffle takes a thread that Spark keeps for a minute, and a
    full collection after each, as the JVM widens its heap when much time goes into them.
    """
    ends = edges.select(F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("end"))
    both = cut(ends.select("end.src", "end.dst").distinct())
    labels = cut(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.col("src")).alias("component")))
    while True:
        own = labels.select(F.col("node").alias("src"), F.col("component").alias("dst"), F.col("component").alias("own"))
        reach = both.withColumn("own", F.lit(None).cast("long")).union(own)
        found = reach.join(labels.toDF("dst", "component").hint("merge"), "dst")
        lowest = F.min("component")
        moved = cut(found.groupBy(F.col("src").alias("node")).agg(lowest.alias("component"), (lowest < F.min("own")).alias("moved")))
        labels = moved.select("node", "component")
        if moved.filter("moved").isEmpty():
            return labels

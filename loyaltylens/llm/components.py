"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltylens.llm.common import keep


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; the root is the smallest node that it is connected to.

    ``edges`` has two columns of long numbers.  Every round links each node's larger neighbours to the smallest one
    around it, then its smaller neighbours, until all edges of a component lead to its root.  Edges stay as many as
    they were at most; a node with many neighbours is first reduced per task.  Each round is a table in the shared
    folder.
    """
    a, b = edges.columns
    directed = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = keep(directed.distinct())
    before = None
    while True:
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            break
        before = tuple(state)
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        larger = both.filter(F.col("v") > F.col("u")).join(lowest, "u")
        larger = larger.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        lowest = larger.groupBy("u").agg(F.min("v").alias("low"))
        smaller = larger.join(lowest, "u").filter(F.col("v") != F.col("low"))
        current = keep(
            smaller.select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionAll(lowest.select("u", F.col("low").alias("v"))).distinct()
        )
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )

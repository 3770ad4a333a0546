"""Connected components of an edge table that no single machine has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def connected_components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(id, root) for each end of an edge (a, b); root is the smallest id that can be reached.

    Each round takes the least label of the neighbours and then the label of that label, so a path shortens
    as fast as it doubles. Every round is written to the shared folder.
    """
    both = written(
        edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
        .unionByName(edges.select(F.col("b").alias("src"), F.col("a").alias("dst")))
        .distinct(),
        "edges",
    )
    labels = written(both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("root")).withColumnRenamed("src", "id"), "labels")
    for _ in range(rounds):
        near = both.join(labels.select(F.col("id").alias("dst"), "root"), "dst").groupBy("src").agg(F.min("root").alias("near"))
        step = labels.join(near.withColumnRenamed("src", "id"), "id").select("id", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        far = labels.select(F.col("id").alias("root"), F.col("root").alias("far"))
        new = written(step.join(far, "root").select("id", "old", F.least("root", "far").alias("root")), "labels")
        labels = new.select("id", "root")
        if new.filter(F.col("root") < F.col("old")).isEmpty():
            return labels
    raise RuntimeError(f"components have not settled in {rounds} rounds")

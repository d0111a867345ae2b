"""Connected components of a large graph of small components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.tables import written


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of every node of ``a, b`` rows.

    Labels pass over edges and then jump to their own label's label, until none
    changes: about as many rounds as the logarithm of the longest path. Labels and
    edges are written between rounds; all that is grouped is a minimum.
    """
    both = edges.union(edges.select("b", "a")).toDF("src", "dst").distinct()
    both = written(both, "graph-edges")
    own = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("component"))
    labels = written(own.withColumnRenamed("src", "id"), "graph-labels")
    while True:
        near = both.join(labels, both.src == labels.id).groupBy("dst").agg(
            F.min("component").alias("offered")
        )
        hop = labels.join(near, labels.id == near.dst).select(
            "id", F.least("component", "offered").alias("next"), F.col("component").alias("was")
        )
        hop = written(hop, "graph-hop")
        target = hop.select(F.col("id").alias("named"), F.col("next").alias("component"))
        jumped = hop.join(target, hop.next == target.named).select("id", "component", "was")
        jumped = written(jumped, "graph-labels")
        labels = jumped.select("id", "component")
        if jumped.filter("component <> was").isEmpty():
            return labels

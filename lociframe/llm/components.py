"""Connected components of large graphs by minimum labels and pointer jumping."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every end of the edges (a, b): label is the smallest id that the edges reach.

    Ids are longs; loops and repeated edges do no harm, null ends are dropped. Each round lowers labels
    over the edges and then jumps to the label's label, so long chains need few rounds. Rounds end when
    nothing changes. Minima are combined before the shuffle; joins on a node of many edges have a unique
    other side, which adaptive execution splits. Each round is written, so none is replayed.
    """
    edges = edges.select("a", "b").filter("a is not null and b is not null")
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("id"), "label"), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels["id"] == near["a"]).select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        heads = labels.select(F.col("id").alias("label"), F.col("label").alias("head"))
        new = written(lower.join(heads, "label").select("id", "old", F.least("label", "head").alias("label")), "labels")
        labels = new.select("id", "label")
        if new.filter("label <> old").isEmpty():
            return labels

"""Connected components of an edge table by min-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): each node of an edge with the smallest node of its component.

    ``edges`` has bigint columns a, b in any direction.  Labels stay in written
    tables; the driver only sees how many changed.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .filter("a <> b").distinct(), "cc-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("comp")), "cc-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m")))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        step = (labels.join(near, "node").join(jump, "comp")
                .select("node", F.least("m", "further").alias("new"), F.col("comp").alias("old")))
        step = written(step.select("node", F.least("new", "old").alias("comp"), (F.least("new", "old") < F.col("old")).alias("moved")), "cc-labels")
        labels = step.select("node", "comp")
        if not step.filter("moved").limit(1).count():
            return labels

"""Connected components of a link table by repeated joins; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): the smallest node reachable from each node that has a link.

    Every round gives each node the smallest label among itself and its neighbours and then the
    label of that label, so distances halve; rounds are stored and end when no label changes.
    """
    ways = [F.struct(F.col(x).alias("node"), F.col(y).alias("other")) for x, y in ((a, b), (b, a))]
    edges = stored(links.select(F.inline(F.array(*ways))).distinct(), "edges")
    labels = stored(edges.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    while True:
        other = labels.select(F.col("node").alias("other"), F.col("label").alias("near"))
        near = edges.join(other, "other").groupBy("node").agg(F.min("near").alias("near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        step = step.join(jump, "new").select("node", "label", F.least("new", "far").alias("new"))
        step = stored(step, "labels")
        labels = step.select("node", F.col("new").alias("label"))
        if step.where(F.col("new") != F.col("label")).isEmpty():
            return labels

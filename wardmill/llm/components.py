"""Connected components of links, as labels that spread by joins and jump along themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node, label for every node of ``links`` (a, b): the smallest node that is reachable.

    Each round a node takes the least label of its neighbours and then that label's own label. Sums and joins by node
    only; nothing but one count per round reaches the driver.
    """
    edges = links.select("a", "b").where("a <> b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b")).distinct()
    edges = written(edges, "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "near").alias("label"), F.col("label").alias("before"))
        spread = written(spread, "spread")
        onward = spread.select(F.col("node").alias("of"), F.col("label").alias("onward"))
        jumped = spread.join(onward, spread["label"] == onward["of"]).select("node", F.least("label", "onward").alias("label"), "before")
        jumped = written(jumped, "labels")
        labels = jumped.select("node", "label")
        if not jumped.where("label <> before").limit(1).count():
            return labels

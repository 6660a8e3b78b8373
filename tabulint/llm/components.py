"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulint.llm.storage import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); the label is the least node of its component.

    Each round a node takes the least label among its own and its neighbours', and then the label of
    that label, so that a chain shrinks by more than half; the rounds end when no label moves.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    both = stored(both, "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("of")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels["node"] == near["of"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        hooked = stored(hooked, "labels")
        roots = hooked.select(F.col("node").alias("root"), F.col("label").alias("further"))
        jumped = hooked.join(roots, hooked["label"] == roots["root"]).select("node", "old", F.least("label", "further").alias("label"))
        jumped = stored(jumped, "labels")
        labels = jumped.select("node", "label")
        if jumped.filter("old <> label").isEmpty():
            return labels

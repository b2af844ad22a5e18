"""Connected components as joins and aggregations over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.util import store


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): label is the smallest node reachable.

    Each round every node takes the smallest label among its neighbours, then its label's label, so
    long chains halve; a written table ends each round. Nodes may be of any ordered type; links may repeat.
    """
    both = store(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label"))
    labels = store(labels, "labels")
    while True:
        seen = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        step = labels.join(seen, "node").select("node", "label", F.least("label", "low").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        new = store(step.join(jump, "near").select("node", F.least("near", "far").alias("next"), "label"), "labels")
        changed = not new.where(F.col("next") != F.col("label")).isEmpty()
        labels = new.select("node", F.col("next").alias("label"))
        if not changed:
            return labels

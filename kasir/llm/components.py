"""Connected components of a link table by label propagation with jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kasir.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the smallest node it
    can reach. Each round takes the smallest label among a node's neighbours
    and then that label's own label, so paths shorten by doubling. Rounds are
    staged; minima are combined in each task, so a hub costs no more than its
    links."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = staged(both.distinct(), "links")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a")
                .agg(F.min("label").alias("near")))
        step = (labels.join(near, labels["node"] == near["a"])
                .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("beyond"))
        new = staged(step.join(jump, step["label"] == jump["via"], "left")
                     .select("node", "old", F.least("label", F.coalesce("beyond", "label")).alias("label")),
                     "labels")
        changed = new.where("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels

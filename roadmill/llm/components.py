"""Connected components over a table of links, without gathering links or nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch


def connected_components(links: DataFrame) -> DataFrame:
    """links(u long, v long): (node, component), component being the least node reachable. Each round every node
    hooks to the least label among its neighbours and itself, then labels jump to their label's label; star
    shapes end in two rounds, chains in about log n. Hot nodes meet in aggregates, which combine before the
    shuffle."""
    both = scratch(links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "cc-links")
    labels = scratch(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")).withColumnRenamed("u", "node"), "cc-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, "node").select("node", F.least("label", "near").alias("new"), "label")
        # a node's old label also learns of the least label that its members met
        root = hooked.groupBy(F.col("label").alias("at")).agg(F.min("new").alias("least"))
        jumped = hooked.join(root, F.col("label") == F.col("at")).select("node", F.least("new", "least").alias("new"), "label")
        again = jumped.select(F.col("node").alias("target"), F.col("new").alias("target_label"))
        fresh = scratch(jumped.join(again, F.col("new") == F.col("target")).select("node", F.least("new", "target_label").alias("new"), "label"), "cc-labels")
        moved = fresh.where("new <> label").limit(1).count()
        labels = fresh.select("node", F.col("new").alias("label"))
        if not moved:
            return labels.withColumnRenamed("label", "component")

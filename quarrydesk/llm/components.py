"""Connected components of a link table by minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrydesk.session import write_out


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every end of ``links(a, b)``; a component is named by its smallest node.

    Every round gives a node the least label around it, then that label's own label. Nothing is collected
    but one count a round. Rows with a null end are no links; no links give no rows.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = write_out(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                     "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("other")).select(
        "node", F.least("node", "other").alias("component"))
    labels = write_out(labels, "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("near"))
        lower = labels.join(seen, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        lower = lower.join(jump, "component", "left").select(
            "node", "old", F.coalesce(F.least("component", "further"), "component").alias("component"))
        lower = write_out(lower, "labels")
        labels = lower.select("node", "component")
        if not lower.where("component <> old").limit(1).count():
            return labels

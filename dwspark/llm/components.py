"""Connected components by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, files: int | None = None) -> DataFrame:
    """(a, b) -> (node, component): each linked node with the least node that
    it reaches. Rounds grow with the logarithm of the longest chain; each
    round's labels are a table in the shared folder, of ``files`` files at most."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links", files)
    labels = stored(both.groupBy("a").agg(F.min("b").alias("least"))
                    .select(F.col("a").alias("node"), F.least("a", "least").alias("component")), "labels", files)
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("other")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other")))
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"),
                                                 F.least("component", "other").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        new = stored(lower.join(jump, "component", "left")
                     .select("node", F.least("component", "further").alias("component"), "old"), "labels", files)
        labels = new.drop("old")
        if not new.filter("component != old").limit(1).count():
            return labels

"""Connected components of a link table, as joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """``id, label`` of every linked id; the label is the least id of its component.

    ``links`` has columns ``a, b``. Each round an id takes the least label among its
    neighbours, and then that label's own label, so chains shorten by halves. Every round is
    written to the shared folder, and the loop ends when no label changes.
    """
    both = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    edges = stored(both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = stored(edges.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("near")))
    labels = labels.select("id", F.least("id", "near").alias("label"), F.col("id").alias("old"))
    while True:
        near = edges.join(labels.select(F.col("id").alias("dst"), "label"), "dst").groupBy(F.col("src").alias("id"))
        near = near.agg(F.min("label").alias("near"))
        moved = labels.join(near, "id").select("id", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        heads = labels.select(F.col("id").alias("label"), F.col("label").alias("head"))
        labels = stored(moved.join(heads, "label").select("id", F.least("label", "head").alias("label"), "old"))
        if labels.where("label <> old").isEmpty():
            return labels.select("id", "label")

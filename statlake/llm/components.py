"""Connected components of links between rows, as joins and sums over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.scratch import scratch_table


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every id of the links (a, b); the label is the least id of its component.

    Each round takes the least label among a row's neighbours and then the label of that label, so that
    the distance to the least id more than halves; no component is ever in one place.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch_table(both.where("a <> b").distinct(), "links")
    labels = scratch_table(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")), "labels"
    )
    while True:
        near = both.join(labels, both["b"] == labels["id"]).select(F.col("a").alias("id"), "label")
        least = near.unionByName(labels).groupBy("id").agg(F.min("label").alias("label"))
        least = scratch_table(least, "labels")
        far = least.select(F.col("id").alias("label"), F.col("label").alias("next"))
        jumped = least.join(far, "label").select("id", F.col("next").alias("label"))
        jumped = scratch_table(jumped, "labels")
        moved = jumped.join(labels.withColumnRenamed("label", "old"), "id").where("label <> old")
        if moved.isEmpty():
            return jumped
        labels = jumped

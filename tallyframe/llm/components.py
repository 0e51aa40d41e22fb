"""Connected components of links, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import rows_in, stage


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``vertex`` and ``label`` (the smallest vertex of its component) of every linked vertex.

    Each round takes the smallest label among a vertex and its neighbours, and then the
    label of that label, so that long chains take a number of rounds in the logarithm of
    their length in most cases. Rounds end when no label changes. A round is written to the
    shared folder; nothing but the count of changes comes to the driver. No links, no rows.
    """
    both = links.select(F.col(left).alias("vertex"), F.col(right).alias("other"))
    both = stage(
        both.union(both.select(F.col("other").alias("vertex"), F.col("vertex").alias("other"))).distinct(),
        "links",
    )
    labels = stage(
        both.groupBy("vertex").agg(F.min("other").alias("low")).select(
            "vertex", F.least("vertex", "low").alias("label")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("vertex").alias("other"), F.col("label").alias("seen")), "other")
            .groupBy("vertex")
            .agg(F.min("seen").alias("seen"))
        )
        lowered = labels.join(near, "vertex").select("vertex", "label", F.least("label", "seen").alias("low"))
        jumped = stage(
            lowered.join(
                lowered.select(F.col("vertex").alias("low"), F.col("low").alias("lower")), "low", "left"
            ).select("vertex", F.col("label").alias("old"), F.least("low", F.coalesce("lower", "low")).alias("label")),
            "labels",
        )
        changed = rows_in(jumped.filter("old <> label"))
        labels = jumped.select("vertex", "label")
        if not changed:
            return labels

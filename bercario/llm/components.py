"""Connected components of links, by passing on the least label.

Every step gives each node the least label among its neighbours' and its label's own, so a star
takes two steps and a chain a number that grows with its logarithm. Each step is one join and one
aggregation, and is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bercario.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node reachable, for every node of links (a, b)."""
    # Both directions of a row in one pass: a union of the two would compute the links twice. Links are
    # few and come from many tasks; dealt anew they are in few files, which every step reads.
    there, back = F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = stored(links.select(F.inline(F.array(there, back))).distinct(), "links")
    first = both.groupBy("a").agg(F.min("b").alias("least"))
    labels = stored(
        first.select(F.col("a").alias("node"), F.least("a", "least").alias("label")), "labels"
    )
    while True:
        # A node asks its neighbours, and the node that is its label, for their labels.
        asked = both.withColumn("own", F.lit(None).cast("long")).unionByName(
            labels.select(F.col("node").alias("a"), F.col("label").alias("b"), F.col("label").alias("own"))
        )
        heard = asked.join(labels, asked["b"] == labels["node"]).groupBy("a")
        step = heard.agg(F.min("label").alias("label"), F.max("own").alias("own"))
        step = stored(
            step.select(F.col("a").alias("node"), "label", (F.col("label") != F.col("own")).alias("changed")),
            "labels",
        )
        labels = step.select("node", "label")
        if step.filter("changed").isEmpty():
            return labels

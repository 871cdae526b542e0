"""Connected components of an edge table, as rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the least node of its component.

    Each round a node takes the least label among its neighbours, then the
    label of its label (pointer jumping), so long chains halve per round.  All
    joins are between written tables: a node or label with very many rows is
    an ordinary skewed join that Spark can split, and minima are pre-aggregated.
    """
    both = materialise(
        edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")).where(F.col("u") != F.col("v")).distinct(),
        "links",
    )
    labels = materialise(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")).withColumnRenamed("u", "node"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        hooked = materialise(
            labels.join(near, F.col("node") == F.col("u")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")),
            "labels-hooked",
        )
        up = hooked.select(F.col("node").alias("parent"), F.col("label").alias("root"))
        jumped = materialise(hooked.join(up, F.col("label") == F.col("parent")).select("node", "old", F.col("root").alias("label")), "labels")
        if jumped.where(F.col("old") != F.col("label")).isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")

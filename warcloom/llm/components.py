"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _step(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Every node takes the least label around it, then its label's label."""
    around = (
        edges.join(labels.toDF("b", "_near"), "b").groupBy(F.col("a").alias("node")).agg(F.min("_near").alias("_near"))
    )
    nearer = labels.join(around, "node", "left").select("node", F.least("component", F.coalesce("_near", "component")).alias("component"))
    parents = labels.toDF("component", "_up")
    return nearer.join(parents, "component", "left").select(
        "node", F.least("component", F.coalesce("_up", "component")).alias("component"))


def _edges(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
    return both.distinct()


def first_labels(links: DataFrame) -> DataFrame:
    """(node, component) after one round: nodes with equal labels are connected, not the reverse."""
    return (
        _edges(links).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_b"))
        .select("node", F.least("node", "_b").alias("component"))
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) with the least node of each component as its name.

    ``links`` has columns a and b. Each round is one join per step and is cut
    with checkpoint(); label chains halve each round, so the number of rounds
    follows the logarithm of the longest path.
    """
    edges = cut_lineage(_edges(links))
    labels = cut_lineage(first_labels(links))
    while True:
        new = cut_lineage(_step(edges, labels))
        changed = new.join(labels.toDF("node", "_old"), "node").where("component <> _old").limit(1).count()
        labels = new
        if not changed:
            return labels

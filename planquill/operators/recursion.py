"""Recursive UNION without duplicates, which SQL here only has with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reachable(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(node) reached from ``start`` over ``edges`` (a, b), each once: rounds of join and anti-join until
    no new node is found. A round's nodes are checkpointed, so lineage does not grow."""
    from planquill.runtime import checkpoint_dir

    checkpoint_dir(edges.sparkSession)
    edges = edges.checkpoint()
    found = start.select("node").distinct().checkpoint()
    front = found
    while not front.isEmpty():
        after = front.join(edges, F.col("node") == F.col("a")).select(F.col("b").alias("node")).distinct()
        front = after.join(found, "node", "left_anti").checkpoint()
        found = found.union(front)
    return found

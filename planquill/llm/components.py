"""Connected components of an edge table by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import dropped, stored


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) for every node in ``edges`` (a, b); the label is the smallest node of the component.

    Each round shortens every node's path to its root and hooks roots and nodes onto the smallest
    grandparent of a neighbour, so rounds grow with the logarithm of a component's diameter. A round's result is a
    written table, so a lost executor costs a round at most. Null ends and loops are ignored; an empty
    table has no components.
    """
    one = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    both = stored(one.select("a", "b").union(one.select(F.col("b"), F.col("a"))).distinct(), "edges")
    last = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("p")), "parents")
    parents = last
    while True:
        up = parents.select(F.col("node").alias("p"), F.col("p").alias("gp"))
        grand = parents.join(up, "p").select("node", "p", "gp")
        near = both.join(grand.select(F.col("node").alias("b"), F.col("gp").alias("m")), "b").groupBy(F.col("a").alias("node")).agg(F.min("m").alias("m"))
        hooks = near.join(parents, "node")
        offers = (
            grand.select("node", F.col("gp").alias("v"), F.col("p").alias("old"))
            .unionByName(hooks.select("node", F.col("m").alias("v"), F.lit(None).cast(parents.schema["p"].dataType).alias("old")))
            .unionByName(hooks.select(F.col("p").alias("node"), F.col("m").alias("v"), F.lit(None).cast(parents.schema["p"].dataType).alias("old")))
        )
        new = stored(offers.groupBy("node").agg(F.min("v").alias("v"), F.max("old").alias("old")).select("node", F.least("v", "old").alias("p"), "old"), "parents")
        moved = new.where(F.col("p") != F.col("old")).limit(1).count()
        dropped(last)
        last, parents = new, new.select("node", "p")
        if not moved:
            dropped(both)
            return parents.select("node", F.col("p").alias("label"))

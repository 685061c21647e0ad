"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); the component is its least node.

    Each round hangs every node's neighbours under the least of them; the number of rounds
    grows with the logarithm of the longest chain. What is read again is written first, and
    no neighbourhood is gathered in one row.
    """
    links = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    while True:
        # Large star: larger neighbours go under the least of node and neighbours.
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("least")))
        large = (
            both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
            .distinct()
        )
        large = materialize(large)
        # Small star: smaller neighbours and the node itself go under the least of them.
        least = materialize(large.groupBy("a").agg(F.min("b").alias("least")))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("b", "least"), F.struct(F.col("a").alias("b"), "least"))).alias("x"))
            .select(F.col("x.b").alias("a"), F.col("x.least").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        small = materialize(small)
        # Done when every node hangs under one that hangs under none.
        roots = small.select(F.col("b").alias("a")).distinct()
        if small.join(roots, "a", "left_semi").isEmpty() and small.groupBy("a").count().filter("count > 1").isEmpty():
            break
        links = small
    return small.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        small.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

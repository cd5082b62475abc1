"""Connected components of a graph given as a table of edges, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inciscope.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge: root is the least node of its component.

    ``edges`` has (a, b) in any direction; loops and repeats do no harm. Each round hangs a node's neighbours on the
    least of them, first the larger neighbours, then the smaller ones; the number of rounds grows with the logarithm of
    the size. Least neighbours are aggregated before the shuffle and joined back, so a hub's edges can be split.
    """
    a, b = F.col("a"), F.col("b")
    down = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    current, state = materialise(down, "components"), None
    while True:
        both = current.union(current.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), a).alias("m"))
        large = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("m").alias("b")).where(a != b).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a")
        small = hung.select(b.alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        current = materialise(small.where(a != b).distinct(), "components")
        found = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    return current.select(a.alias("node"), b.alias("root")).union(current.select(b, b).distinct())

"""Connected components of a link table by alternating large and small stars.

The large star hangs a node's greater neighbours under the least node it knows,
the small star does the same with its lesser ones; both keep the components and
flatten every one into a star around its least node in a logarithmic number of
rounds. A round is grouped minima and joins only, so no group of links is ever
gathered, and each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecast.llm.common import store


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; root is the least node it reaches."""
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct()
    edges = store(edges, "links")
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == before or mark[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct())
        before = tuple(mark)
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(floor, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = store(small.union(floor).distinct(), "links")

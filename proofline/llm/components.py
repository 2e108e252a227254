"""Connected components of a table of links, by repeated min-label rounds with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm.text import materialized


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); component is the smallest node reachable.

    Links point from the larger to the smaller node. Each round hangs all neighbours of a node under
    its smallest neighbour and then under that one's, so path lengths shrink by a factor and the
    number of rounds grows with the logarithm of the longest path. Each round is a written table; what
    reaches the driver is one number a round. Null ends are ignored; no links give no rows.
    """
    flat = links.where("a is not null and b is not null and a <> b")
    edges = materialized(flat.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: larger neighbours hang under the lowest one
        large = edges.withColumnsRenamed({"a": "v", "b": "u"}).join(lowest.withColumnRenamed("a", "u"), "u")
        large = materialized(large.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "links")
        # small star: smaller neighbours and the node itself hang under the lowest one
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small_low.select("a", F.col("m").alias("b")))
        new = materialized(small.where("a <> b").distinct(), "links")
        changed = new.join(edges, ["a", "b"], "left_anti").limit(1).count() + edges.join(new, ["a", "b"], "left_anti").limit(1).count()
        edges = new
        if not changed:
            break
    own = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(own)

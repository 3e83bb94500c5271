"""Connected components of an edge table by alternating star contraction.

Large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014) turn the edges into stars around each component's
least node in a logarithmic number of rounds, whatever the diameter.  Each
round is written to the shared checkpoint folder; the driver sees counters only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (a, b) with a > b."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    met = both.join(least, both.a == least.u)
    if large:  # nodes above u move to u's least neighbour
        out = met.where("b > u").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # nodes below u, and u, move to it
        out = met.select(F.explode(F.array("b", "u")).alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node of the links ``pairs`` (two bigint columns); root: the least node."""
    a, b = pairs.columns
    edges = written(pairs.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(),
                    "components")
    while not edges.isEmpty():
        new = written(_star(_star(edges, True), False), "components")
        # a set of stars does not change any more: both steps give it back
        if new.count() == edges.count() and new.exceptAll(edges).isEmpty():
            break
        edges = new
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root")))

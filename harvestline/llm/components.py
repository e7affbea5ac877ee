"""Connected components of an edge table by alternating star contraction.

Each round hangs larger neighbours on the smallest one seen (large star),
then smaller neighbours likewise (small star), until the edges are stars
around the smallest node of each component; pairs and stars need no round.  Minima are pre-aggregated before the
shuffle; the joins are ordinary ones, so a node with a third of all edges is
split by the skew handling of adaptive execution.  No link, node or label
ever comes to the driver, only one answer a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars already: nobody hangs on two nodes, or on one that hangs on another."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    found = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return found.where("hangs > 1 or (hangs = 1 and holds = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) → (node, component): the smallest node reachable.

    Only nodes with an edge to another node are returned.  Null ends and
    self-loops are ignored; an empty table gives an empty result.
    """
    e = (edges.where("a is not null and b is not null and a <> b")
              .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    e = stored(e.distinct(), "edges")
    while not _settled(e):  # every round brings the edges of a node closer to the smallest one
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _least(both).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.where("u <> v").distinct()
        low = _least(large)
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionByName(low.select("u", F.col("m").alias("v"))))
        e = stored(small.where("u <> v").distinct(), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

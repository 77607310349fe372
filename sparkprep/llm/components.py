"""Connected components of a graph given as a table of edges.

Alternating star contraction: every round points the larger neighbours of a node
at the smallest node it knows (large star), then the smaller ones (small star),
until the edges form stars. The number of rounds grows with the logarithm of the
longest chain. Each step of a round is written to the shared folder, and the one
before deleted, so that a plan never holds more than one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkprep.llm.common import Scratch


def connected_components(
    edges: DataFrame, a: str = "a", b: str = "b", keep: Scratch | None = None
) -> DataFrame:
    """``node, root`` for every node with an edge to another; root is the smallest node reached.

    The result reads the table ``edges`` of ``keep``, which the caller may drop after use.
    The smallest neighbours are found with map-side combining. Both sides of a join are
    stored tables, merged: Spark splits a node with very many edges, and nothing is broadcast.
    """
    x, y = F.col(a), F.col(b)
    keep = keep or Scratch(edges.sparkSession)
    ends = edges.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
    now = keep.put("edges", ends.distinct())
    while not _stars(least := keep.put("least", _smallest(now))):
        nearest = least.select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
        # The larger end of every edge goes to the smallest node that the other end knows.
        large = now.join(nearest.hint("merge"), "v").select("u", F.col("m").alias("v"))
        large = keep.put("large", large)
        least = keep.put("least", large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least.hint("merge"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = keep.put("edges", small.union(least).distinct())
    keep.drop("least", "large")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _smallest(now: DataFrame) -> DataFrame:
    """``u, m, n``: of every node its smallest neighbour and the number of its edges."""
    ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    both = now.select(F.explode(ends).alias("e")).select("e.u", "e.v")
    return both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))


def _stars(least: DataFrame) -> bool:
    """Whether every node is the smallest of its neighbours or has one edge only, to a smaller node."""
    return least.where("m < u and n > 1").isEmpty()

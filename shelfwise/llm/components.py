"""Connected components of an edge table by alternating stars, without gathering any neighbourhood.

A large star links each node's larger neighbours to the least node of its neighbourhood, a small star
does so with the smaller ones; both are an aggregate and a join on the node.  A node with very many
neighbours is one row on the aggregate's side, so its join partition can be split; the rounds grow with
the logarithm of the longest path.  Each round is written to the shared folder and replaces the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Scratch
from shelfwise.session import shuffles_freed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    onward = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return onward.union(least.select("a", F.col("m").alias("b"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node leads to one root, and no root leads on (edges are distinct, from a to a smaller b)."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("leads"), F.lit(0).alias("led")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    wrong = ends.groupBy("n").agg(F.sum("leads").alias("leads"), F.max("led").alias("led")).filter(
        "leads > 1 or (leads = 1 and led = 1)")
    with shuffles_freed(edges.sparkSession):
        return wrong.isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of its component, for each node of ``edges`` (a, b) but the roots.

    Ids are any ordered type without nulls; edges may repeat, point either way or lead to themselves.
    """
    scratch = Scratch(edges.sparkSession, "edges")
    edges = scratch.keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .distinct())
    while not _are_stars(edges):
        before, edges = edges, scratch.keep(_small_star(_large_star(edges)))
        scratch.drop(before)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))

"""Connected components of a link table by repeated contraction, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardspark.session import stage


def components(links: DataFrame) -> DataFrame:
    """Label the vertices of undirected links (a, b): one row (vertex, root) per vertex that has a link.

    In each round every vertex joins its neighbour of least hash, unless its own is less; the links between the
    joined vertices go on to the next round. Hashes differ by round, so a path shrinks by a constant part
    whatever its ids are, and a star of any size in one round. Each round is written to the shared
    folder. When no links are left, the rounds' tables are followed back from the last.
    """
    both = links.where("a <> b")
    edges = stage(both.select("a", "b").unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    rounds = []
    while edges.take(1):
        order = lambda c, k=len(rounds): F.struct(F.xxhash64(F.lit(k), c).alias("h"), c.alias("v"))
        least = edges.groupBy("a").agg(F.min(order(F.col("b"))).alias("m"))
        joins = stage(least.select("a", F.least(F.col("m"), order(F.col("a")))["v"].alias("p")), "joins")
        rounds.append(joins)
        left = joins.select("a", F.col("p").alias("pa"))
        right = joins.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        moved = edges.join(left, "a").join(right, "b").where("pa <> pb")
        edges = stage(moved.select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), "links")
    if not rounds:
        return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    roots = rounds.pop().select(F.col("a").alias("vertex"), F.col("p").alias("root"))
    while rounds:
        later = roots.select(F.col("vertex").alias("p"), F.col("root"))
        earlier = rounds.pop()
        roots = stage(
            earlier.join(later, "p", "left").select(F.col("a").alias("vertex"), F.coalesce("root", "p").alias("root")), "roots"
        )
    return roots

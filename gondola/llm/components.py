"""Connected components of a graph given by its edges, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gondola.sources.shared import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest one. In a large star each node links its larger
    neighbours to the least of all; in a small star it links its smaller ones and itself."""
    around = _both_ways(edges) if large else edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = around.join(least, "u")
    if large:
        moved = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the smallest node that it is
    connected with. Alternates large and small stars until nothing changes, a number of rounds
    that grows with the logarithm of the longest chain. Every round is a written table; a node
    of many links is a skewed key of a join, which adaptive execution splits. An action."""
    stars = materialize(edges.where("u <> v").distinct(), "edges")
    mark = _mark(stars)
    while mark[0]:
        stars = materialize(_star(_star(stars, large=True), large=False), "edges")
        before, mark = mark, _mark(stars)
        if mark == before:
            break
    roots = stars.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())

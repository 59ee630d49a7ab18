"""Connected components by alternating large and small stars, all in shuffles: no neighbourhood is ever gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comarca.llm.common import Scratch


def _with_least(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """pairs (u, v) with the least of u and all its v as m. The least is cut off first, so that the join can split hot u."""
    least = scratch.cut(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
    return pairs.join(least, "u")


def _large(edges: DataFrame, scratch: Scratch) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both, scratch).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame, scratch: Scratch) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_least(down, scratch)
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(linked.select("u", F.col("m").alias("v")))


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("u") != F.col("v")).distinct()


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """edges (u, v), longs. Returns node, component (the least node reachable) for every node of an edge between two nodes.

    The result reads a table of scratch.
    """
    edges = scratch.cut(_tidy(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))))
    mark = _mark(edges)
    while mark[0]:
        with Scratch(scratch.spark, "stars") as round_:
            linked = scratch.cut(_tidy(_small(round_.cut(_tidy(_large(edges, round_))), round_)))
        scratch.drop(edges)
        edges, now = linked, _mark(linked)
        if now == mark:
            break
        mark = now
    # Converged edges are stars: every node points at the least of its component.
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())

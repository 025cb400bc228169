"""Connected components of an edge table, as Spark joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.session import materialise


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _to_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each directed edge with the least id among u and what u points to."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the least id reachable, for every id of the edges (columns a and b) but the least ones.

    Alternating star contraction: every node hands its larger neighbours to the least one (large star), then its
    smaller neighbours likewise (small star), until the edges are stars around the least ids. Each round is
    a handful of groupings with partial minima and joins whose hot keys adaptive execution splits; the
    edges shrink and are written each round, so a lost executor costs one round at most. Ids that only
    point to themselves, or to nothing, have no row.
    """
    u, v = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    now = materialise(edges.where(F.col("a") != F.col("b")).select(u, v).distinct(), "edges")
    before, mark = None, _fingerprint(now)
    while mark != before and mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        starred = _to_least(large.where(F.col("u") != F.col("v")).distinct())
        small = starred.select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
        )).alias("e")).select("e.u", "e.v")
        now = materialise(small.where(F.col("u") != F.col("v")).distinct(), "edges")
        before, mark = mark, _fingerprint(now)
    return now.select(F.col("u").alias("id"), F.col("v").alias("component"))

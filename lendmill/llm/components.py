"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm.runtime import for_join
from lendmill.session import materialize


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _least(pairs: DataFrame, rows: int) -> DataFrame:
    """(u, v, m): m is the smallest of u and its neighbours; there are at most `rows` pairs."""
    least = pairs.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("of"), F.least("u", "low").alias("m"))
    return pairs.join(for_join(least, rows), pairs["u"] == least["of"]).select("u", "v", "m")


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both, 2 * rows).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    met = _least(down, rows)
    return met.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of the edges (columns u, v): the smallest node reachable.

    Self-loops and repeated edges do no harm; a node that only has self-loops is not listed. Every
    round writes its edges to the shared folder, so the lineage stays short; the number of rounds
    grows with the logarithm of the table.
    """
    now = materialize(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    before = _state(now)
    while before[0]:
        now = materialize(_small_star(_large_star(now, before[0]), 2 * before[0]).distinct(), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    # a star per component: every node points at its least one
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())

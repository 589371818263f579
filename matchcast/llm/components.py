"""Connected components by alternating stars, each round one shuffle of the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchcast.llm.common import join_groups, release, settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours to the least of them: the larger ones, or the smaller ones and itself."""
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = settle(near.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
    joined = join_groups(near, least, ["a"], "n", F.col("b"), "inner")
    m = F.least("a", "m")
    if large:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("x"), m.alias("y"))
    else:
        out = joined.select(F.col("b").alias("x"), m.alias("y")).unionByName(least.select(F.col("a").alias("x"), m.alias("y")))
    out = settle(out.filter("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    release(least)
    return out


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the least node that is reachable.

    Neighbourhoods are never gathered: a round takes each node's least neighbour by a pre-aggregated
    minimum and joins it back, splitting nodes that hold a large share of all edges. Rounds are
    logarithmic in the nodes, each written to the shared folder; only two numbers a round come to
    the driver.
    """
    now = settle(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    mark = _print(now)
    while mark[0]:
        wide = _star(now, large=True)
        release(now)
        now = _star(wide, large=False)
        release(wide)
        was, mark = mark, _print(now)
        if was == mark:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )

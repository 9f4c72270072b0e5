"""Connected components of an edge table by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearshelf.sources.tables import stage


def _pairs(df: DataFrame) -> DataFrame:
    """Distinct edges with the smaller end as ``a``; loops go."""
    ends = df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ends.where(F.col("a") < F.col("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node hangs on the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m"))
    joined = both.where(F.col("b") > F.col("a")).join(lowest, "a")
    return _pairs(joined.select(F.least("a", "m").alias("a"), "b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang on the smallest of them."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(lowest, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return _pairs(moved.union(lowest.select(F.col("m").alias("a"), F.col("u").alias("b"))))


def components(edges: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """(``node``, ``root``) of every node with an edge to another; ``root`` is the smallest node.

    ``edges`` has ``a`` and ``b`` of an orderable type; null ends and loops are left out, and
    repeated edges count once. Each round joins edges with the minima of neighbourhoods (a partial
    aggregate, so that no neighbourhood meets in one task) and writes its edges to the shared
    folder. The edges of a component end as a star around its smallest node.
    """
    now = stage(_pairs(edges.where(F.col("a").isNotNull() & F.col("b").isNotNull())), "edges")

    def state(df: DataFrame) -> tuple:
        mix = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        return tuple(df.agg(F.count(F.lit(1)), mix).first())

    before = state(now)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        now = stage(_small_star(_large_star(now)), "edges")
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not converge")
    nodes = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return nodes.union(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())

"""Connected components of a graph whose edges are a table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` for every end of the edges (columns `a`, `b`): the smallest node that it is connected to.

    Each round links the larger neighbours of every node to its smallest one, then the smaller ones; a component is a
    star around its smallest node after a number of rounds that grows with the logarithm of its size. Every round is
    written out, so its lineage is cut. So is the smallest neighbour of each node before it meets the edges: of two
    stored tables Spark can split the side on which a common node has very many edges. Null ends and loops are dropped;
    no edges give no rows.
    """
    up, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    now = stored(edges.filter(F.col("a") != F.col("b")).select(up, low).distinct(), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        now = stored(_small_star(_large_star(now)), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()

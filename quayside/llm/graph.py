"""Connected components of an edge table by alternating large and small stars
(Kiveris et al. 2014): every step is a partial aggregate and an equi-join, and
the edge table is written to the shared folder after each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return C.spread_join(both, least, ["a"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    near = C.spread_join(down, least, ["a"])
    return near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(near.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); the
    component is its least node.  The driver sees two numbers a round."""
    now = C.written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state.n == 0 or state == before:
            break
        before = state
        now = C.written(_small_star(_large_star(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

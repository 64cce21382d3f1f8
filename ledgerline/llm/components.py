"""Connected components of a table of edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b: long) is connected to.

    Rows with a null end and loops are ignored; a node without any other edge
    doesn't come back.  Only counts and sums reach the driver.
    """
    now = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = F.expr("count(*) as n"), F.expr("sum(cast(xxhash64(a, b) as decimal(38,0))) as s")
    before = now.agg(*mark).first()
    for _ in range(rounds):
        if not before["n"]:
            break
        now = stored(_small_star(_large_star(now)), "edges")
        after = now.agg(*mark).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()

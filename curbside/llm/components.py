"""Connected components of an edge table by alternating stars; nothing is gathered in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curbside.llm.common import discard, staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the smallest of the node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(pairs: DataFrame) -> tuple[DataFrame, str]:
    """From links (u, v) of longs: (u, v) with the smallest node v of each other node u; and the table's path."""
    edges = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    edges, path = staged(edges, "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges, path
        before = state
        step, next_path = staged(_small_star(_large_star(edges)), "edges")
        discard(pairs.sparkSession, path)
        edges, path = step, next_path

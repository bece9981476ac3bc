"""Connected components of an edge table, as Spark jobs.

Alternates two star contractions until nothing changes: every node first
hands its larger neighbours, then its smaller ones, to its smallest neighbour.
Each half-round joins two written tables, so a node with very many edges is a
skewed join that Spark splits, and a lost executor re-reads files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialize


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = materialize(edges.union(edges.select("v", "u")), "edges")
    low = materialize(_minima(both).select("u", F.least("u", "m").alias("m")), "minima")
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    low = materialize(_minima(down), "minima")
    # the smaller neighbours that move, and the node itself (once, from the minima)
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its
    smallest node.  Loops and repeated edges do no harm."""
    now = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        now = materialize(_small_star(_large_star(now).distinct()).distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    heads = now.select(F.col("v").alias("node")).distinct()
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(heads.select("node", F.col("node").alias("component"))))

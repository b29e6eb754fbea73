"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.base import staged


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Columns ``id`` and ``comp``: for each node with an edge to another, the smallest id it reaches.

    Each round links every node's larger neighbours, then all of its smaller
    ones, to its smallest neighbour. Both are an aggregate (partial before
    its shuffle, so a node with very many edges is no hot key) and a join of
    the edges with one row for each node, which Spark can split when skewed.
    It ends when each component is a star around its smallest id. Edges with
    a null end, loops and repeated edges are ignored; no edge gives an empty
    table. The edges of each round are written to the shared folder.
    """
    e = edges.select(F.col(src).cast("long").alias("a"), F.col(dst).cast("long").alias("b"))
    e = e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = staged(e, "edges")
    while not _stars(e):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        e = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        e = e.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("x")).select("x.a", "x.b").where("a <> b").distinct()
        e = staged(e, "edges")
    return e.select(F.col("a").alias("id"), F.col("b").alias("comp")).union(
        e.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct()
    )


def _stars(e: DataFrame) -> bool:
    """Has every larger end one edge only, and is none of them a smaller end?"""
    ends = e.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        e.select("b", F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("a").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up + down > 1 and up > 0").isEmpty()

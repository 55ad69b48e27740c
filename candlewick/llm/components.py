"""Connected components of an edge table, as rounds of large-star / small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import staged_with


def _rows(df: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    out, seen = staged_with(df, name, n=F.count(F.lit(1)),
                            s=F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")))
    return out, (seen.get("n"), seen.get("s"))


def star_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of the undirected graph ``edges(u, v)`` (orderable ids).

    Returns ``(u, v)``: every node that is not its component's smallest, with that
    smallest node.  Each round links a node's larger neighbours to its smallest one
    (large star), then the smaller ones (small star); the edge count never grows and a
    round without change ends the loop, after O(log n) rounds in practice.  A hub is a
    partial ``min`` and an ordinary equi-join, which AQE splits.  Every round is written
    to the shared scratch folder, so lineage stays short and survives lost executors.
    Self-loops, repeated edges and nulls in either column are ignored.
    """
    cur = (edges.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
           .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    cur, mark = _rows(cur, "cc-edges")
    for _ in range(max_rounds):
        if not mark[0]:
            return cur
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = (both.filter("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        cur, new = _rows(small, "cc-round")
        if new == mark:
            return cur
        mark = new
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")

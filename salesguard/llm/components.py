"""Connected components of a link table, by alternating stars.

Each round hooks every node's larger neighbours to its smallest one (large
star), then its smaller neighbours likewise (small star), until the links are
stars around each component's smallest node. Links stay in Spark; rounds are
cut by ``checkpoint``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sum(df: DataFrame) -> tuple:
    r = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def stars(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``links`` has columns ``a, b`` of one orderable type. Returns ``node, root``
    for every node of a component of two or more, the root being its smallest
    node. Loops, nulls, repeats and either direction are fine; without links the
    result is empty. Raises if ``rounds`` do not settle it (a chain of n nodes
    takes about log n).
    """
    e = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = e.checkpoint()
    seen = _sum(e)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()          # a > b holds: m <= a < b
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("x"))
        e = small.select("x.a", "x.b").where("a <> b").distinct().checkpoint()
        now = _sum(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()

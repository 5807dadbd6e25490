"""Connected components of a link table, as rounds of DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortium.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())


def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``; the root is the
    smallest node of the component.

    Alternates two star steps until the links no longer change: each node hands
    its larger neighbours to its smallest one, then its smaller neighbours. Every
    step is an aggregate (with map-side combine) and an equi-join, so a hub with
    a third of all links is split like any skewed join; the number of rounds grows
    with the logarithm of the longest chain. Each round is written once in the
    shared folder, so a lost executor costs a re-read. NULLs and self-links form
    no link; an empty table gives no rows.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "links")
    mark = _mark(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        edges = stored(small, "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

"""Connected components of an undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortkit.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the least node of its component.

    Alternates two star contractions until nothing moves: neighbours above a node are
    attached to its least neighbour, then neighbours below it. Rounds grow with the
    logarithm of a component's size and the edges never exceed their first number. Minima
    are combining aggregates; joining them back is a plain join that AQE may split. Every
    round is written to the shared folder.
    """
    c = F.col
    pairs = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    cur, seen = staged(pairs, "graph"), None
    while True:
        both = cur.union(cur.select(c("v").alias("u"), c("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        down = both.filter("v > u").join(low, "u").select(c("v").alias("u"), c("m").alias("v")).filter("u != v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").filter("v != m").select(c("v").alias("u"), c("m").alias("v"))
        cur = staged(moved.union(least.select("u", c("m").alias("v"))).distinct(), "graph")
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return cur.select(c("u").alias("node"), c("v").alias("root")).union(cur.select(c("v").alias("node"), c("v").alias("root")).distinct())

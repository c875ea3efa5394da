"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.session import pin, unpin

EDGES_A_TASK = 50_000  # a task that writes a round meets at most about twice as many


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, at_most: int | None = None) -> DataFrame:
    """node, root (smallest node of its component) for every node of the edges (u, v) but the roots themselves; `unpin` removes it.

    Each round hangs all larger neighbours of a node on its smallest one, then all smaller ones; the number of edges
    never grows, a hub is a join key that Spark may split, and nothing but two sums a round reaches the driver. So as many
    tasks write a round as the edges of the one before need; `at_most`, if known, bounds the edges given.
    """
    now = pin(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(),
        at_most and -(-at_most // EDGES_A_TASK),
    )
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        after = pin(after, -(-state[0] // EDGES_A_TASK))
        unpin(now)
        now, before = after, state
        state = _state(now)
        if state == before:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots._pinned_at = now._pinned_at
    return roots

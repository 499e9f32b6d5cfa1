"""Connected components of an edge list by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.session import in_tasks, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest one."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest one."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a != b")


def star_round(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """Edges (a > b) of the same components, each nearer to its smallest node; written.

    ``rows`` is the number of edges where it is known; a step puts out at most twice as many."""
    most = None if rows is None else 2 * rows
    large = in_tasks(in_tasks(_large_star(edges), most).distinct(), most)
    return materialize(in_tasks(in_tasks(_small_star(large), most).distinct(), most), "edges")


def connected_components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """node, root (the component's smallest node) for every end of an edge.

    ``edges`` has columns a and b of one ordered type; nulls and loops are
    ignored, repeated edges count once. Every round is written to the shared
    folder, so neither lineage nor driver grows; the driver sees two numbers a
    round. Where ``rows``, the number of edges, is given, steps run in as many tasks
    as those ask for. The number of rounds is logarithmic in the length of chains.
    """
    current = materialize(in_tasks(edges.select("a", "b").filter("a != b").distinct(), rows), "edges")
    seen = None
    while True:
        stars = star_round(current, rows)
        # equal count and equal hash sum: the round changed nothing
        now = stars.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == seen:
            break
        seen, current = now, stars
    nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.union(in_tasks(roots, rows))

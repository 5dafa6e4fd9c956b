"""Connected components of a graph given as edges, by alternating star contractions.

Each round hangs all larger neighbours of a node on the smallest node it knows, then all
smaller ones. Both are a minimum by node (combined before the shuffle) and a join. Rounds are
written to the shared folder, so a lost executor never repeats an earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.session import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (
        both.filter("b > a")
        .join(least, "a")
        .select(F.least("a", "least").alias("a"), "b")
        .filter("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have a < b; b's smaller neighbours and b itself go to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    moved = edges.join(least, "b").filter("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("least").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reachable.

    No edges: no rows. Repeated edges, loops and both directions are allowed; null ends are ignored.
    """
    now = staged(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before, after = None, state(now)
    while before != after:
        now = staged(_small_star(_large_star(now)), "edges")
        before, after = after, state(now)
    roots = now.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("root"))
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(roots)

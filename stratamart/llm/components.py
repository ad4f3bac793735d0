"""Connected components by alternating star operations, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import stored


def _star(pairs: DataFrame, keep_root: bool) -> DataFrame:
    """Tie each neighbour v of u to the smallest of u and its neighbours.

    ``pairs`` is a stored table (u, v): the hot side of the join is a plain shuffle that adaptive execution can split.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = pairs.join(stored(least), "u")
    return tied.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if not keep_root else tied.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        tied.select("u", F.col("m").alias("v"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); the root is the component's smallest node.

    Large-star and small-star steps alternate until no edge changes; a component of n nodes needs O(log n) rounds or so.
    Each round is stored, so that lineage stays short and a lost executor costs one round.  No edges give no rows.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen
        both = stored(now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        large = stored(_star(both, keep_root=False).distinct())
        now = stored(_star(large, keep_root=True).filter("u <> v").distinct())

"""Trees kept as rows with a parent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F


def closure(rows: DataFrame, stored: Callable[[DataFrame], DataFrame], id: str = "id", parent: str = "parent_id") -> tuple[DataFrame, DataFrame]:
    """(id, ancestor, distance) of every row and each of its ancestors, itself at distance 0; and (id, cycle) of rows whose way up never ends.

    Pointer doubling: a row that knows its ancestors up to distance d asks the one at distance d for its own, so a tree of depth n takes log2(n) joins.  A way
    that is still open after more steps than there are rows goes in a circle; ``cycle`` is the circle's smallest id.  Rows on and below circles have no ancestors here but
    are reported.  A parent that is no row ends the way; of several rows of one id the one with the smallest parent counts.  ``stored`` keeps each step's result (a checkpoint or a written
    table), as each step uses the one before it twice.
    """
    keep = stored
    nodes = keep(rows.select(F.col(id).alias("id"), F.col(parent).alias("up")).filter(F.col("id").isNotNull()).groupBy("id").agg(F.min("up").alias("up")))
    up = nodes.join(nodes.select(F.col("id").alias("up")), "up", "left_semi").select("id", F.col("up").alias("to"))
    # ``to``: 2^k steps up; ``least``: the smallest id on the way there.
    jump, step, total = keep(up.withColumn("least", F.col("id"))), 1, nodes.count()
    jumps = [jump.select("id", "to")]
    while step <= total and not jump.isEmpty():
        ahead = jump.select(F.col("id").alias("to"), F.col("to").alias("next"), F.col("least").alias("further"))
        jump = keep(jump.join(ahead, "to").select("id", F.col("next").alias("to"), F.least("least", "further").alias("least")))
        jumps.append(jump.select("id", "to"))
        step *= 2
    circle = jump.select(F.col("id").alias("to"), F.col("least").alias("cycle"))  # more steps than rows: all of the circle
    lost = keep(jump.select("id", "to").join(circle, "to").select("id", "cycle"))
    reach = nodes.join(lost, "id", "left_anti").select("id", F.col("id").alias("ancestor"), F.lit(0).cast("bigint").alias("distance"))
    for k, far in enumerate(jumps):  # ways shorter than 2^k become ways shorter than 2^(k+1)
        beyond = reach.select(F.col("id").alias("to"), "ancestor", (F.col("distance") + (1 << k)).alias("distance"))
        reach = keep(reach.union(far.join(beyond, "to").select("id", "ancestor", "distance")))
    return reach, lost


def placed(regions: DataFrame, levels: list[tuple[str, str]], id: str = "id", parent: str = "parent_id", name: str = "name") -> DataFrame:
    """One row per region with an (id, name) pair of columns for itself and each level above it, nearest first.

    The walk goes over the regions, which are few, once; facts then look all levels up in one join.
    """
    own = [F.col(id).alias("_own"), F.col(parent).alias("_up"), F.col(id).alias(levels[0][0]), F.col(name).alias(levels[0][1])]
    at = regions.select(*own)
    for column, label in levels[1:]:
        above = regions.select(F.col(id).alias(column), F.col(name).alias(label), F.col(parent).alias("_next"))
        at = at.join(above, F.col("_up") == F.col(column), "left").drop("_up").withColumnRenamed("_next", "_up")
    return at.drop("_up")

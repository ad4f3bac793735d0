"""Top n per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def top_ranked(df: DataFrame, group: Sequence[str], measure: str, n: int, rank: str = "rk") -> DataFrame:
    """Rows whose ``rank()`` by ``measure`` (descending) within the group is at most n; ties stay.

    A group may hold most of the table, and most of a group may tie.  So rows are
    first counted per distinct value; at most n distinct values of a group can
    rank within n, which lets the window drop the rest before its shuffle.  The
    few values that qualify are then joined back to the rows.
    """
    values = df.groupBy(*group, measure).agg(F.count(F.lit(1)).alias("_ties"))
    by_value = Window.partitionBy(*group).orderBy(F.col(measure).desc_nulls_last())
    best = (
        values.withColumn("_place", F.row_number().over(by_value))
        .filter(F.col("_place") <= n)
        .withColumn("_through", F.sum("_ties").over(by_value.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(rank, (F.col("_through") - F.col("_ties") + 1).cast("int"))
        .filter(F.col(rank) <= n)
        .select(*[F.col(c).alias(f"_{c}") for c in group], F.col(measure).alias("_value"), rank)
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group]
    same.append(F.col(measure).eqNullSafe(F.col("_value")))
    on = same[0]
    for condition in same[1:]:
        on = on & condition
    return df.join(best, on).drop(*[f"_{c}" for c in group], "_value")

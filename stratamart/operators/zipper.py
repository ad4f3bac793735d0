"""Validity ranges."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.functions.columns import OPEN_END, stable_id


def opened(start: Column) -> list[Column]:
    """Validity of a row that has no successor yet."""
    return [start.alias("start_date"), F.lit(OPEN_END).alias("end_date")]


def zipper_merge(current: DataFrame, incoming: DataFrame, key: str, day: dt.date) -> DataFrame:
    """Close the open row of every key that changed and open its new row.

    ``current`` has start_date and end_date; ``incoming`` has the other columns.
    """
    values = [c for c in current.columns if c not in ("start_date", "end_date")]
    is_open = F.col("end_date") == OPEN_END
    closed_before = current.filter(~is_open)
    old = current.filter(is_open).select(F.struct(*values).alias("old"), F.col(key).alias("_k"), "start_date")
    new = incoming.select(F.struct(*values).alias("new"), F.col(key).alias("_k2"))
    both = old.join(new, F.col("_k") == F.col("_k2"), "full")
    unchanged = F.col("new").isNull() | F.col("old").eqNullSafe(F.col("new"))
    yesterday = F.lit((day - dt.timedelta(days=1)).isoformat())
    old_end = F.when(unchanged, F.lit(OPEN_END)).otherwise(yesterday)
    versions = F.array_compact(
        F.array(
            F.when(F.col("old").isNotNull(), F.struct(F.col("old").alias("v"), F.col("start_date").alias("s"), old_end.alias("e"))),
            F.when(
                F.col("new").isNotNull() & ~F.col("old").eqNullSafe(F.col("new")),
                F.struct(F.col("new").alias("v"), F.lit(day.isoformat()).alias("s"), F.lit(OPEN_END).alias("e")),
            ),
        )
    )
    moved = both.select(F.inline(versions)).select("v.*", F.col("s").alias("start_date"), F.col("e").alias("end_date"))
    return closed_before.unionByName(moved)


def scd_columns(as_of: dt.date, keys: Sequence[str]) -> list[Column]:
    """Surrogate key and slowly-changing-dimension fields of a first version."""
    return [
        stable_id(*keys).alias("surrogate_key"),
        F.lit(as_of).alias("effective_date"),
        F.date_add(F.lit(as_of), 365 * 10).alias("expiry_date"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version"),
    ]

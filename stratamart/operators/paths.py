"""Ordered steps within a session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def numbered_steps(
    df: DataFrame,
    session: Sequence[str],
    order: Sequence[str],
    page: str,
    slice_of: Column,
) -> DataFrame:
    """Adds ``step`` (1, 2, … in order) and ``next_page`` within each session.

    Same result as ``row_number`` and ``lead`` over the session, but no task has
    to hold a whole session.  ``slice_of`` cuts a session into stretches that
    follow one another in ``order`` (for example the minute of the event): windows
    run per stretch, and the first row of a stretch, with the stretch's size, stands for it when
    offsets and the page after each stretch are carried over along the session.

    Rows are shuffled once, by a key that is one column: the stretches' first rows are read from the
    same shuffle (both sides use the same columns of it), the offsets come back by the same key, and null sessions meet themselves.
    """
    key = F.struct(*session, slice_of.alias("_slice"))
    rest = [c for c in df.columns if c not in session]
    sliced = df.select(key.alias("_key"), *rest)
    inside = Window.partitionBy("_key").orderBy(*order)
    size = F.count(F.lit(1)).over(Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    local = sliced.select("*", F.row_number().over(inside).alias("_local"), F.lead(page).over(inside).alias("_next"), size.alias("_size"))
    along = Window.partitionBy(*[F.col("_key")[c] for c in session]).orderBy(F.col("_key._slice"))
    offsets = local.filter("_local = 1").select(
        F.col("_key").alias("_of"), F.coalesce(F.sum("_size").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.lead(page).over(along).alias("_after")
    )
    columns = [F.col("_key")[c].alias(c) if c in session else F.col(c) for c in df.columns]
    return local.join(offsets, F.col("_key") == F.col("_of")).select(
        *columns,
        (F.col("_before") + F.col("_local")).cast("int").alias("step"),
        F.when(F.col("_local") == F.col("_size"), F.col("_after")).otherwise(F.col("_next")).alias("next_page"),
    )


def first_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The first row of each key.  An aggregate, so it combines before the shuffle."""
    first = F.min_by(F.struct(*keep), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(first.alias("_row")).select(*keys, "_row.*")


def latest_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The last row of each key, by the same means."""
    last = F.max_by(F.struct(*keep), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(last.alias("_row")).select(*keys, "_row.*")

"""Filters that every layer starts from."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F


def partition_of(df: DataFrame, day: dt.date, column: str = "dt") -> DataFrame:
    """One day of a table.  The literal is compared to the bare column, so it prunes."""
    return df.filter(F.col(column) == F.lit(day))


def live(df: DataFrame, flag: str = "is_deleted") -> DataFrame:
    """Rows that are not soft-deleted."""
    return df.filter(F.col(flag) == "0")


def changes(df: DataFrame, kind: str = "insert") -> DataFrame:
    """Change rows of one kind."""
    return df.filter(F.col("type") == kind)

"""Dimension lookups.

No side is marked for broadcast.  Spark broadcasts a side whose size, known from
statistics or measured at run time, is below its threshold, and joins by shuffle
above it, so a dimension may grow without a plan change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_label(
    df: DataFrame,
    dictionary: DataFrame,
    code: str,
    label: str,
    parent: str | None = None,
    code_column: str = "dic_code",
    name_column: str = "dic_name",
    how: str = "left",
) -> DataFrame:
    """Adds the name of a code, from the part of the dictionary under ``parent``."""
    if parent is not None:
        dictionary = dictionary.filter(F.col("parent_code") == parent)
    names = dictionary.select(
        F.col(code_column).cast("string").alias("_code"), F.col(name_column).alias(label)
    )
    return df.join(names, F.col(code).cast("string") == F.col("_code"), how).drop("_code")


def with_columns_of(
    df: DataFrame, dimension: DataFrame, key: str, dimension_key: str, take: dict[str, str], how: str = "left"
) -> DataFrame:
    """Adds ``{dimension column: new name}`` by key."""
    side = dimension.select(
        F.col(dimension_key).alias("_key"), *[F.col(c).alias(name) for c, name in take.items()]
    )
    return df.join(side, F.col(key) == F.col("_key"), how).drop("_key")

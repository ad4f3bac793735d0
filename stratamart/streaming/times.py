"""Event time and watermarks.  Rows without a usable time are told apart, not given time zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def timed(df: DataFrame, millis: Column, delay: str, name: str = "et") -> DataFrame:
    return df.withColumn(name, F.timestamp_millis(millis)).withWatermark(name, delay)


def by_field(df: DataFrame, field: str, delay: str, value: str = "value") -> DataFrame:
    """Event time from a named millisecond field of a JSON text."""
    return timed(df, F.get_json_object(value, f"$.{field}").try_cast("bigint"), delay)


def by_field_or(df: DataFrame, first: str, second: str, delay: str, value: str = "value") -> DataFrame:
    """Event time in seconds from one field, or from another where that is missing."""
    seconds = F.coalesce(*[F.get_json_object(value, f"$.{f}").try_cast("bigint") for f in (first, second)])
    return timed(df, seconds * 1000, delay)


def by_first_element(df: DataFrame, field: str, delay: str, value: str = "value") -> DataFrame:
    """Event time from the first element of a JSON list."""
    return timed(df, F.get_json_object(value, f"$[0].{field}").try_cast("bigint"), delay)


def without_time(df: DataFrame, name: str = "et") -> DataFrame:
    return df.filter(F.col(name).isNull())

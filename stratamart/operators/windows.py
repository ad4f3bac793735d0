"""Aggregates over the last n days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.functions.columns import days_before


def recent_days(df: DataFrame, as_of: dt.date, windows: Sequence[int] = (1, 7, 30), day: str = "dt") -> DataFrame:
    """One copy of a row for each window that holds its day.

    The widest window is a plain range filter, so it reaches the scan.  A row is
    copied only into windows it belongs to, and the aggregate that follows
    combines the copies before its shuffle.
    """
    spans = F.array(*[F.lit(n) for n in windows])
    inside = F.filter(spans, lambda n: F.datediff(F.lit(as_of), F.col(day)) < n)
    return (
        df.filter((F.col(day) > days_before(as_of, max(windows))) & (F.col(day) <= F.lit(as_of)))
        .withColumn("recent_days", F.explode(inside))
    )


def rolled_sums(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
    as_of: dt.date,
    windows: Sequence[int] = (7, 30),
    day: str = "dt",
) -> DataFrame:
    """1-day layer to n-day layer in one pass: ``{output stem: input column}``
    becomes one sum per window, named ``stem_<n>d``."""
    in_span = df.filter((F.col(day) > days_before(as_of, max(windows))) & (F.col(day) <= F.lit(as_of)))
    aggs = []
    for n in windows:
        for stem, source in measures.items():
            value: Column = F.col(source)
            if n != max(windows):
                value = F.when(F.col(day) > days_before(as_of, n), value).otherwise(F.lit(0))
            aggs.append(F.sum(value).alias(f"{stem}_{n}d"))
    return in_span.groupBy(*keys).agg(*aggs)


def unpivot_windows(df: DataFrame, keys: Sequence[str], stems: Sequence[str], windows: Sequence[int]) -> DataFrame:
    """``stem_7d, stem_30d`` columns to one row per window with plain ``stem`` columns."""
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("recent_days"), *[F.col(f"{s}_{n}d").alias(s) for s in stems])
            for n in windows
        ]
    )
    return df.select(*keys, F.inline(rows))


def day_and_spans(df: DataFrame, as_of: dt.date, measures: Mapping[str, str], spans: Sequence[int], day: str = "dt") -> DataFrame:
    """Rows of ``as_of`` as window 1, and rows of the longest span in every span, zero where they lie outside it: one read of the daily table.

    ``measures`` maps new columns to the daily ones; ``recent_days`` names the window.
    """
    ago = F.datediff(F.lit(as_of), F.col(day))
    zero = lambda c: F.lit(0).cast(df.schema[c].dataType)
    one = F.struct(F.lit(1).alias("recent_days"), *[F.col(c).alias(n) for n, c in measures.items()])
    wide = [F.struct(F.lit(s).alias("recent_days"), *[F.when(ago < s, F.col(c)).otherwise(zero(c)).alias(n) for n, c in measures.items()]) for s in spans]
    kept = df.filter((F.col(day) > days_before(as_of, max(spans))) & (F.col(day) <= F.lit(as_of)))
    taken = set(measures.values())
    return kept.select(*[c for c in df.columns if c not in taken], F.inline(F.when(ago == 0, F.array(one, *wide)).otherwise(F.array(*wide))))

"""Dimensions that change: ranges of validity, and lookups as of the time of each fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

FROM, TO = "_valid_from", "_valid_to"


def validity_ranges(changes: DataFrame, keys: Sequence[str], time: str, version: Sequence[str] = (), gone: Column | None = None) -> DataFrame:
    """Each state of a key with the half-open range of ``time`` in which it holds (no end: still).

    Of several changes of a key at one time the last by ``version`` counts.  Where ``gone`` holds, the key has no state until its next change.  The windows hold
    the changes of one key of a dimension, which are as few as it changes; facts never enter them.
    """
    rest = [c for c in changes.columns if c not in (*keys, time)]
    marked = changes.withColumn("_gone", F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False))
    order = F.struct(*version, "_gone") if version else F.struct("_gone")
    last = marked.groupBy(*keys, time).agg(F.max_by(F.struct(*rest, "_gone"), order).alias("_state"))
    along = Window.partitionBy(*keys).orderBy(time)
    ranges = last.withColumn(FROM, F.col(time)).withColumn(TO, F.lead(time).over(along)).filter(~F.col("_state._gone"))
    return ranges.select(*keys, *[F.col("_state")[c].alias(c) for c in rest], FROM, TO)


def as_of(facts: DataFrame, ranges: DataFrame, on: Mapping[str, str], time: str, take: Mapping[str, str], width: int = 3_600_000, how: str = "left") -> DataFrame:
    """Facts with columns of the state that held at their own time.

    ``on`` maps key columns of the facts to those of the ranges, ``take`` columns of the ranges to new ones; ``time`` and the ranges' ends are whole numbers.

    Time is cut into slices of ``width``: each range goes, cut at their bounds, to the slices in which its key has facts, and facts meet it by key and slice.
    So a code that most facts bear spreads over its slices, and a state that holds for years is copied only where it is looked up.  Facts
    without key or time keep empty columns (``left``) or go (``inner``).
    """
    keys = [f"_k{i}" for i in range(len(on))]
    side = facts.select("*", *[F.col(f).alias(k) for k, f in zip(keys, on)], F.floor(F.col(time) / width).alias("_slice"))
    states = ranges.select(*[F.col(r).alias(k) for k, r in zip(keys, on.values())], FROM, TO, *[F.col(c).alias(n) for c, n in take.items()])
    present = side.select(*keys, "_slice").distinct()
    begin, end = F.col("_slice") * width, (F.col("_slice") + 1) * width
    cut = present.join(states, keys).filter((F.col(FROM) < end) & (F.col(TO).isNull() | (F.col(TO) > begin)))
    cut = cut.withColumn(FROM, F.greatest(FROM, begin)).withColumn(TO, F.coalesce(F.least(TO, end), end))
    cut = cut.select(*[F.col(c).alias(f"_r{c}") for c in (*keys, "_slice", FROM, TO)], *take.values())
    met = (F.col("_slice") == F.col("_r_slice")) & (F.col(time) >= F.col(f"_r{FROM}")) & (F.col(time) < F.col(f"_r{TO}"))
    for k in keys:
        met = met & (F.col(k) == F.col(f"_r{k}"))
    return side.join(cut, met, how).select(*facts.columns, *take.values())

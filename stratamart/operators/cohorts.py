"""Retention, churn, return and runs of active days."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.functions.columns import days_before, rate


def active_days(df: DataFrame, user: str, as_of: dt.date, span: int = 7, day: str = "dt") -> DataFrame:
    """Per user, which of the last ``span`` days (63 at most) were active, as a bigint of bits.

    Bit i stands for the day i days before ``as_of``.  One row per user, whatever
    the number of events, and combined before the shuffle.
    """
    if span > 63:
        raise ValueError("a bigint holds 63 days")
    shift = F.datediff(F.lit(as_of), F.col(day))
    in_span = df.filter((F.col(day) > days_before(as_of, span)) & (F.col(day) <= F.lit(as_of)))
    return in_span.groupBy(user).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)).alias("days"))


def has_run(days: Column, length: int, span: int = 7) -> Column:
    """Whether ``length`` consecutive days are set."""
    masks = [((1 << length) - 1) << i for i in range(span - length + 1)]
    return reduce(lambda a, b: a | b, [days.bitwiseAND(F.lit(m)) == F.lit(m) for m in masks])


def has_cluster(days: Column, count: int, within: int, span: int = 7) -> Column:
    """Whether some stretch of ``within`` days holds at least ``count`` active days."""
    full = (1 << within) - 1
    tests = [F.bit_count(days.bitwiseAND(F.lit((full << i) & ((1 << span) - 1)))) >= count for i in range(span)]
    return reduce(lambda a, b: a | b, tests)


def retention(df: DataFrame, as_of: dt.date, first: str, last: str, span: int = 7) -> DataFrame:
    """Cohorts of the last ``span`` days before ``as_of``: who came back on ``as_of``."""
    cohort = df.filter((F.col(first) >= days_before(as_of, span)) & (F.col(first) < F.lit(as_of)))
    back = F.count_if(F.col(last) == F.lit(as_of))
    return cohort.groupBy(F.col(first).alias("create_date")).agg(
        back.alias("retention_count"), F.count(F.lit(1)).alias("new_user_count")
    ).select(
        F.lit(as_of).alias("dt"),
        "create_date",
        F.datediff(F.lit(as_of), F.col("create_date")).alias("retention_day"),
        "retention_count",
        "new_user_count",
        rate(F.col("retention_count") * 100, "new_user_count", 2).alias("retention_rate"),
    )

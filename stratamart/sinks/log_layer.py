"""The click log as a table of page views by day, loaded in steps.

A step parses its lines once and sends each to the day of its own time, however late it comes; it writes only partitions (day, step) of its own, so a repeated step
replaces itself and no other day is read or written.  Reports then prune days, where the raw log would be parsed from its beginning.
"""

from __future__ import annotations

import datetime as dt
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart.operators.scans import partition_of
from stratamart.plans.shop_dwd import dwd_page_view
from stratamart.sinks.tables import counted, write_partitions

STEP = "step"


def load_step(lines: DataFrame, path: str, step: int | str, zone: str, files_per_day: int | None = None) -> int:
    """Page views of a step's log lines (column ``log``) into the days they belong to; returns their number."""
    rows, seen = counted(dwd_page_view(lines, zone).withColumn(STEP, F.lit(str(step))), f"step {step}")
    write_partitions(rows, path, ["dt", STEP], files_per_day=files_per_day)
    return seen.get["rows"]


def page_views(spark: SparkSession, path: str) -> DataFrame:
    """All days: what a warehouse reads as the stored table ``dwd_page_view``."""
    rows = spark.read.parquet(path)
    return rows.withColumn("dt", F.col("dt").cast("date")).drop(STEP) if rows.schema["dt"].dataType.simpleString() != "date" else rows.drop(STEP)


def views_of_day(spark: SparkSession, path: str, day: dt.date) -> DataFrame:
    return partition_of(page_views(spark, path), day)

"""New-visitor repair across micro-batches: the streaming twin of ``operators.logs.repair_is_new``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stratamart.functions.columns import in_zone, millis_to_ts
from stratamart.operators.logs import first_visits, with_first_visits
from stratamart.operators.versions import FROM, TO, as_of
from stratamart.sinks.keyed import current_rows, manifest, merge_rows, replace_rows, rows_of
from stratamart.streaming.touched import slots


def repaired(parsed: DataFrame, path: str, zone: str, ttl_ms: int | None = None) -> DataFrame:
    """Parsed log lines of one micro-batch with flags corrected by each device's first visit.

    The first visit is the earliest line of the device in this and all earlier batches, whatever order its lines come in.  It is kept at
    ``path``, one row per device.  With ``ttl_ms`` a device that is silent for longer than that starts anew, also within a batch.
    """
    if ttl_ms is not None:
        return _repaired_lives(parsed, path, zone, ttl_ms)
    spark = parsed.sparkSession
    seen = first_visits(parsed)
    if manifest(spark, path) is not None:
        known = rows_of(spark, path, seen.select("_mid"))
        seen = seen.unionByName(known.select(*seen.columns))
    merge_rows(seen.groupBy("_mid").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last")), path, ["_mid"])
    return with_first_visits(parsed, current_rows(spark, path), zone)


def lives(stretches: DataFrame, gap: int) -> DataFrame:
    """(mid, begin, old, end): stretches of a device's time joined where no silence longer than ``gap`` lies between them.

    Stretches are few: one per slot of ``gap`` milliseconds in which a device was seen, or a kept life.
    """
    along = Window.partitionBy("mid").orderBy("begin", "end")
    before = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    cut = stretches.withColumn("_new", F.coalesce(F.col("begin") - before > gap, F.lit(True)).cast("int"))
    numbered = cut.withColumn("_life", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.min(F.struct(F.col("begin").alias("ts"), "old"))
    return numbered.groupBy("mid", "_life").agg(first.alias("_f"), F.max("end").alias("end")).select("mid", F.col("_f.ts").alias("begin"), F.col("_f.old").alias("old"), "end")


def _repaired_lives(parsed: DataFrame, path: str, zone: str, gap: int) -> DataFrame:
    """Lines judged by the first line of the life they fall in.

    All lives of a device are kept, one row each, so the lives do not depend on how lines are cut into batches or in which order these come; a late line that
    closes a gap joins two lives.  Flags that were sent before stay as they were sent.
    """
    spark = parsed.sparkSession
    lines = parsed.filter(~F.col("dirty") & F.col("mid").isNotNull() & F.col("ts").isNotNull())
    new = slots(lines, "mid", "ts", F.col("is_new") != "1", gap)
    touched = new.select("mid").distinct().persist()
    try:
        known = rows_of(spark, path, touched)
        both = new if known is None else new.unionByName(known.select(*new.columns))
        replace_rows(lives(both, gap), touched, path, ["mid", "begin"], ["mid"])
    finally:
        touched.unpersist()
    ranges = current_rows(spark, path).select("mid", "begin", "old", F.col("begin").alias(FROM), (F.col("end") + 1).alias(TO))
    named = as_of(parsed, ranges, {"mid": "mid"}, "ts", {"begin": "_begin", "old": "_old"})
    local = lambda ts: in_zone(millis_to_ts(ts), zone).cast("date")
    first_day = F.when(F.col("_old"), F.date_sub(local("_begin"), 1)).otherwise(local("_begin"))
    fixed = F.when((F.col("is_new") == "1") & (first_day != local("ts")), F.lit("0")).otherwise(F.col("is_new"))
    return named.withColumn("is_new", fixed).drop("_begin", "_old")

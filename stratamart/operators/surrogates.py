"""Surrogate keys from a kept map: dense, stable over loads, and never one number for two keys."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from stratamart.sinks.keyed import drop_folder, manifest, merge_rows, stored_rows

NUMBER = "surrogate_key"


def numbered(rows: DataFrame, keys: Sequence[str], first: int, folder: str) -> DataFrame:
    """Distinct rows of ``keys`` numbered from ``first`` on.

    Rows are range-partitioned by their keys and written to ``folder`` with their part and place, so that lost executors cannot deal them anew; the parts' counts, one row
    per part, give the offsets.  No window spans the table.
    """
    spread = rows.select(*keys).distinct().repartitionByRange(*keys).sortWithinPartitions(*keys)
    within = F.monotonically_increasing_id()  # part in the upper 31 bits, place in the lower 33
    placed = spread.withColumn("_at", within).select("*", F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_place"))
    placed.write.parquet(folder)
    placed = rows.sparkSession.read.parquet(folder)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(offsets), "_part").select(*keys, (F.lit(first) + F.col("_before") + F.col("_place")).cast("bigint").alias(NUMBER))


def assign_keys(rows: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the surrogate key of each natural key; natural keys not met before get the next numbers of the map at ``path``.

    The new numbers are written before they are used and the map names them from then on, so a load run again finds its keys numbered and leaves no gap.
    A key with a null in it is a key like others.
    """
    spark = rows.sparkSession
    now = manifest(spark, path)
    known = stored_rows(spark, path)
    new = rows.select(*keys).distinct()
    if known is not None:
        same = [new[k].eqNullSafe(known[k]) for k in keys]
        on = same[0]
        for s in same[1:]:
            on = on & s
        new = new.join(known, on, "left_anti")
    folder = f"{path.rstrip('/')}-new-{uuid.uuid4().hex}"
    merge_rows(numbered(new, keys, 1 + (now.rows if now else 0), folder), path, keys)
    drop_folder(spark, folder)
    numbers = stored_rows(spark, path)
    if numbers is None:  # no rows at all
        return rows.withColumn(NUMBER, F.lit(None).cast("bigint"))
    numbers = numbers.select(*[F.col(k).alias(f"_key_{k}") for k in keys], NUMBER)
    on = None
    for k in keys:
        same = rows[k].eqNullSafe(numbers[f"_key_{k}"])
        on = same if on is None else on & same
    return rows.join(numbers, on, "left").select(*rows.columns, NUMBER)

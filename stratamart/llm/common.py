"""What the operators share: tables, words, intermediate tables and running totals."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

T = TypeVar("T")

#: Words are runs of anything but these six characters (blank, tab, line feed, vertical tab, form feed, return).
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def found_by_workers(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it, also when neither is started in its folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    found_by_workers(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows of text that a Python task holds at once; texts can be long.
BATCH_ROWS = 500
_kept: dict[str, object] = {}


def texts(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, more, text) for a Python operator, in small batches."""
    found_by_workers(docs.sparkSession)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs.select("doc_id", *more, "text")


def kept(key: str, make: Callable[[], T]) -> T:
    """What a Python worker keeps from task to task, one thing at a time: a vocabulary with its memory of words, say."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


class Memory(dict):
    """What ``make`` gave for keys met before.

    Two generations bound it: when the young one is full it becomes the old one, from which keys met again return.  So frequent keys stay.
    """

    LIMIT = 1 << 18

    def __init__(self) -> None:
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def renew(self) -> None:
        """Called between texts: what one text needs is never forgotten under way."""
        if len(self) > self.LIMIT:
            self.old = dict(self)
            self.clear()


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK + "+"), "")


def fold(doc_id: Column, parts: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``parts`` (-1 without an id)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)), F.lit(-1))


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; where none is set, one in the warehouse, which executors reach as well."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints").rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """The same rows from a checkpoint in the shared folder: lost executors don't bring their making back."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str], totals: dict[str, str]) -> DataFrame:
    """Add to each row the sums over the rows before it in its group.

    ``totals`` maps a new column to the one it sums.  Rows are range-partitioned by group and order, so a group of
    any size spreads over many partitions; each partition's total, one row per partition and group, makes the base of the next.
    Columns of ``group`` and ``order`` must not be null.  Rows equal in all of ``order`` come in any order.
    """
    keys = [*group, "_part"]
    rows = stored(df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()))
    before = (Window.unboundedPreceding, -1)
    over_parts = Window.partitionBy(*group).orderBy("_part").rowsBetween(*before)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*before)
    bases = rows.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in set(totals.values())])
    bases = bases.select(*keys, *[F.coalesce(F.sum(v).over(over_parts), F.lit(0)).alias(f"_base_{k}") for k, v in totals.items()])
    rows = rows.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{k}") for k, v in totals.items()])
    return rows.join(bases, keys).select(*df.columns, *[(F.col(f"_base_{k}") + F.col(f"_in_{k}")).alias(k) for k in totals])


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder; each call names another."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written as Parquet in the shared folder and read again."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def released(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of results that have since been stored: it does so when the driver's garbage collector meets them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()

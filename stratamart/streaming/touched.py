"""Joins and summaries of streams without a bound on lateness, by touched keys.

Every side of a join is kept as a table of current rows, dealt to buckets by the join's key.  A micro-batch adds its rows to the sides, finds the keys it touches, reads the
buckets of these keys alone from all sides, makes the result of these keys anew from whole sides and puts it in the place of their old result.  So a row that comes days
late meets what it belongs to, an order that changes takes its old contribution back, and there is no streaming state that grows or must forget.  What a batch costs follows the keys
it touches, not the age of the tables.  A repeated batch makes the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratamart.sinks.keyed import current_rows, merge_rows, replace_rows, rows_of


class Side(NamedTuple):
    """One input of a join: its rows in a batch of changes, their key, and the version by which a later row of a key replaces an earlier one."""

    rows: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    version: Sequence[str] = ("ts_ms",)


def keep_and_touch(batch: DataFrame, path: str, sides: Mapping[str, Side], by: Sequence[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Add a batch to the kept sides; the keys it touches, and all kept rows of these keys."""
    spark = batch.sparkSession
    new = {name: side.rows(batch).dropna(subset=list(by)) for name, side in sides.items()}
    touched = None
    for name, side in sides.items():
        merge_rows(new[name], f"{path}/{name}", side.keys, side.version, by=by)
        found = new[name].select(*by).distinct()
        touched = found if touched is None else touched.union(found)
    touched = touched.distinct().persist()
    whole = {}
    for name, side in sides.items():
        rows = rows_of(spark, f"{path}/{name}", touched)
        whole[name] = new[name].limit(0) if rows is None else rows
    return touched, whole


def by_touched_keys(path: str, sides: Mapping[str, Side], by: Sequence[str], build: Callable[..., DataFrame], keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """A sink for micro-batches: keeps the sides under ``path`` and the table that ``build`` makes of them (by name) under ``path``/result.

    ``by`` are columns of every side and of the result: what a row of the result depends on lies in the sides' rows of its own ``by``.
    """

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        touched = None
        try:
            touched, whole = keep_and_touch(batch, path, sides, by)
            replace_rows(build(**whole), touched, f"{path}/result", keys, by)
        finally:
            batch.unpersist()
            if touched is not None:
                touched.unpersist()

    return each


def deltas_by_touched_keys(
    path: str, sides: Mapping[str, Side], by: Sequence[str], build: Callable[..., DataFrame], grain: Sequence[str], measures: Sequence[str], run: str
) -> Callable[[DataFrame, int], None]:
    """Sums of a result that is made anew for touched keys, per ``grain``, kept up by differences alone.

    ``build`` makes one row per ``by`` and grain with the measures.  What the touched keys gave before is taken back and what they give now is added: one small row
    per grain and batch under ``path``/deltas.  Each result row remembers the batch that made it (``run`` names the checkpoint) and what its key gave before that batch, so a repeated
    batch finds the same differences and replaces them.  Nothing is held for days that are over; a late row opens its key again from the kept sides.
    """
    names = [*by, *grain, *measures]

    def each(batch: DataFrame, number: int) -> None:
        spark, mark = batch.sparkSession, f"{run}/{number}"
        batch = batch.persist()
        touched = None
        try:
            touched, whole = keep_and_touch(batch, path, sides, by)
            now = build(**whole).select(*names)
            kept = rows_of(spark, f"{path}/result", touched)
            if kept is None:
                before = now.limit(0)
            else:  # rows this very batch has made stand for what was before it
                before = kept.filter((F.col("_made_by") != mark) & ~F.col("_before") | (F.col("_made_by") == mark) & F.col("_before")).select(*names)
            before = before.persist()
            both = now.select("*", F.lit(1).alias("_sign")).unionByName(before.select("*", F.lit(-1).alias("_sign")))
            change = both.groupBy(*grain).agg(*[F.sum(F.col(m) * F.col("_sign")).alias(m) for m in measures]).withColumn("_made_by", F.lit(mark))
            replace_rows(change, spark.createDataFrame([(mark,)], "_made_by string"), f"{path}/deltas", [*grain, "_made_by"], ["_made_by"])
            rows = now.withColumn("_before", F.lit(False)).unionByName(before.withColumn("_before", F.lit(True))).withColumn("_made_by", F.lit(mark))
            replace_rows(rows, touched, f"{path}/result", [*by, *grain], by)
            before.unpersist()
        finally:
            batch.unpersist()
            if touched is not None:
                touched.unpersist()

    return each


def summed_deltas(spark: SparkSession, path: str, grain: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The sums as they are now."""
    return current_rows(spark, f"{path}/deltas").groupBy(*grain).agg(*[F.sum(m).alias(m) for m in measures])


def fold_deltas(spark: SparkSession, path: str, grain: Sequence[str], measures: Sequence[str], last: str) -> None:
    """Put all differences but those of the batch ``last`` (run/number), which may still be repeated, into one row per grain."""
    rows = current_rows(spark, f"{path}/deltas").filter(F.col("_made_by") != last)
    marks = rows.select("_made_by").distinct().persist()
    folded = rows.groupBy(*grain).agg(*[F.sum(m).alias(m) for m in measures]).withColumn("_made_by", F.lit("folded"))
    replace_rows(folded, marks.union(spark.createDataFrame([("folded",)], "_made_by string")).distinct(), f"{path}/deltas", [*grain, "_made_by"], ["_made_by"])
    marks.unpersist()


def result(spark: SparkSession, path: str) -> DataFrame:
    return current_rows(spark, f"{path}/result")


def slots(lines: DataFrame, mid: str, ts: str, old: Column, gap: int) -> DataFrame:
    """(mid, begin, old, end): a device's lines of one slot of time no longer than ``gap``: no gap can open inside, so its ends stand for all of them."""
    first = F.min(F.struct(F.col(ts).alias("ts"), old.alias("old")))
    return lines.groupBy(F.col(mid).alias("mid"), F.floor(F.col(ts) / gap).alias("_slot")).agg(first.alias("_f"), F.max(ts).alias("end")).select(
        "mid", F.col("_f.ts").alias("begin"), F.col("_f.old").alias("old"), "end"
    )

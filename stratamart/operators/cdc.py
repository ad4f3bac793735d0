"""Change-stream envelopes.  Every function takes a batch or a streaming DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

ENVELOPE = "op STRING, before MAP<STRING,STRING>, after MAP<STRING,STRING>, source MAP<STRING,STRING>, ts_ms BIGINT"


def decode(df: DataFrame, value: str = "value") -> DataFrame:
    """Change rows from JSON text, with database and table as columns.  Unreadable text is left out."""
    parsed = df.filter(F.col(value).isNotNull()).withColumn("_c", F.from_json(F.col(value).cast("string"), ENVELOPE))
    keep = [c for c in df.columns if c != value]
    return parsed.filter(F.col("_c.op").isNotNull()).select(
        *keep, "_c.*", F.col("_c.source")["db"].alias("db_name"), F.col("_c.source")["table"].alias("table_name")
    )


def log_position() -> list[Column]:
    """Where a change stands in its log: time, file, place in the file, row of the statement.  Missing parts are zero or empty."""
    number = lambda k: F.coalesce(F.col("source")[k].try_cast("bigint"), F.lit(0).cast("bigint")).alias(f"log_{k}")
    return [F.col("ts_ms"), F.coalesce(F.col("source")["file"], F.lit("")).alias("log_file"), number("pos"), number("row")]


LOG_POSITION = ["ts_ms", "log_file", "log_pos", "log_row"]


def of_table(changes: DataFrame, table: str) -> DataFrame:
    """Changes of one table.

    Where messages carry their table beside the text (``source_table``: a header,
    or the topic of each table), other tables are dropped before any text is parsed.
    """
    if "source_table" in changes.columns:
        changes = changes.filter(F.col("source_table") == table)
    return changes.filter(F.col("table_name") == table)


def fields(names: Sequence[str], side: str = "after") -> list[Column]:
    return [F.col(side)[n].alias(n) for n in names]


def turned(field: str, old: str, new: str) -> Column:
    """An update that moved a field from one value to another."""
    return (F.col("op") == "u") & (F.col("before")[field] == old) & (F.col("after")[field] == new)


def became(field: str, new: str) -> Column:
    """An update that changed a field to a value, whatever it was."""
    return (F.col("op") == "u") & F.col("before")[field].isNotNull() & (F.col("after")[field] == new)


def kept_side() -> Column:
    """The row a change is about: the old one for a delete, else the new one."""
    return F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))


def increase(field: str) -> Column:
    """How much a counter grew: all of it for a new row, the difference for an update that raised it, else null."""
    new, old = F.col("after")[field].cast("int"), F.col("before")[field].cast("int")
    return F.when(F.col("op").isin("r", "c"), new).when((F.col("op") == "u") & (new > old), new - old)


def routed_to_dimensions(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Cells for the dimension store, by a routing table that says which source table feeds which dimension.

    One row per column of the change: dimension, md5 row key, column, value.
    Deletes are ignored.  ``config`` has source_table, sink_table, sink_columns
    (comma-separated) and sink_row_key.
    """
    routing = config.select(F.col("source_table").alias("_table"), "sink_table", "sink_columns", "sink_row_key")
    routed = changes.filter(F.col("op") != "d").join(routing, F.col("table_name") == F.col("_table"))
    wanted = F.split("sink_columns", ",")
    cells = F.map_filter("after", lambda k, v: F.array_contains(wanted, k))
    return routed.select(
        "sink_table", F.md5(F.element_at("after", F.col("sink_row_key"))).alias("row_key"), *log_position(), "op", F.explode(cells).alias("column_name", "column_value")
    )

"""Table sinks.  Loads can be repeated: each replaces what it wrote before."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from stratamart.sinks.keyed import (  # noqa: F401  (tables of current rows are sinks too)
    _add, _fs, _names, _read, current_rows, delete_rows, drop_folder, forget_deleted, merge_rows,
)


def write_partition(df: DataFrame, path: str, day: dt.date | str, column: str = "dt", fmt: str = "parquet") -> None:
    """Replace one constant partition."""
    write_partitions(df.withColumn(column, F.lit(str(day))), path, [column], fmt)


def write_partitions(df: DataFrame, path: str, columns: Sequence[str] = ("dt",), fmt: str = "parquet", files_per_day: int | None = None) -> None:
    """Replace the partitions that ``df`` has rows for, and no other.

    ``files_per_day`` groups rows by partition first, with that many writers
    each, so a large day is not written by one task and a small one does not
    become many files.
    """
    if files_per_day:
        salt = F.pmod(F.xxhash64(*[c for c in df.columns if c not in columns]), F.lit(files_per_day))
        df = df.repartition(*[F.col(c) for c in columns], salt)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).format(fmt).save(path)


def write_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replace a catalog table as a whole."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str | None = None, partition_by: Sequence[str] = (), comment: str = "",
    fmt: str = "parquet", replace: bool = False,
) -> None:
    """Declare a table; ``replace`` drops the old declaration first."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{parts} COMMENT '{comment}'{where}")


def repair_table(spark: SparkSession, name: str) -> None:
    """Let the catalog find partitions that were written by path."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A row count taken while the rows are written, with no second job."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:  # nothing has been written yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def accumulate_report(spark: SparkSession, new: DataFrame, path: str) -> str:
    """Add rows to a report once, however often the run is repeated.

    The union is written beside the old report and its folder returned; the
    caller points the catalog at it.  A failed run leaves the old report whole.
    """
    old = _stored(spark, path)
    both = new.distinct() if old is None else old.select(*new.columns).unionByName(new).distinct()
    target = f"{path.rstrip('/')}-{uuid.uuid4().hex[:8]}"
    both.write.parquet(target)
    return target


def write_relational(df: DataFrame, table: str, options: Mapping[str, str], mode: str = "append", batch_rows: int = 1000) -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).option("batchsize", batch_rows).mode(mode).save()


def write_topic(df: DataFrame, servers: str, topic: str | None = None, key: str | None = None, topic_column: str | None = None, **options) -> None:
    """Rows as JSON messages, to one topic or to the topic each row names."""
    topic_messages(df, key, topic_column).write.format("kafka").option("kafka.bootstrap.servers", servers).options(
        **({"topic": topic} if topic else {}), **options
    ).save()


def topic_messages(df: DataFrame, key: str | None = None, topic_column: str | None = None) -> DataFrame:
    body = [c for c in df.columns if c != topic_column]
    out = [F.to_json(F.struct(*body)).alias("value")]
    if key:
        out.insert(0, F.col(key).cast("string").alias("key"))
    if topic_column:
        out.append(F.col(topic_column).alias("topic"))
    return df.select(*out)


def with_day_bucket(df: DataFrame, ts: str = "ts", value: str = "value") -> DataFrame:
    """``day`` bucket (yyyyMMdd) from a time field of a JSON text; seconds are scaled to milliseconds.

    Texts without a usable time go to ``error_bucket``.
    """
    raw = F.get_json_object(value, f"$.{ts}").try_cast("bigint")
    millis = F.when(raw < 10_000_000_000, raw * 1000).otherwise(raw)
    return df.withColumn("day", F.coalesce(F.date_format(F.timestamp_millis(millis), "yyyyMMdd"), F.lit("error_bucket")))


def write_day_buckets(df: DataFrame, path: str, batch: int | str, rows_per_file: int = 1_000_000) -> None:
    """Lines by day; a batch written again replaces its own files and no others."""
    out = df.withColumn("batch", F.lit(str(batch)))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file).partitionBy("batch", "day").text(path)


def pack_day(spark: SparkSession, path: str, day: str, file_bytes: int = 128 << 20, older_than: str | None = None) -> int:
    """Lines of one day that many batches left in small files, in files of about ``file_bytes``; returns their number.

    The files are packed by their measured sizes: whole files go side by side until a bin is full, a larger one is split.  ``older_than`` (a batch mark, compared
    as a number) leaves the files of younger batches alone, which may still be written again.  The packed files lie under ``packed/`` and are added before the small ones go; a run
    that stops in between is made good by the next one, which finds in the names of the packed folder what it holds already.
    """
    root = path.rstrip("/")
    fs, hadoop = _fs(spark, root)
    packed = f"{root}/packed/day={day}"
    done, stopped = set(), []
    for name in _names(spark, packed):
        if "_batches" in _names(spark, f"{packed}/{name}"):
            done |= set(_read(spark, f"{packed}/{name}/_batches").split())
        else:
            stopped.append(name)
    for name in stopped:
        drop_folder(spark, f"{packed}/{name}")
    batches = sorted(n.removeprefix("batch=") for n in _names(spark, root) if n.startswith("batch="))
    small = [b for b in batches if f"day={day}" in _names(spark, f"{root}/batch={b}")]
    small = [b for b in small if older_than is None or int(b) < int(older_than)]
    new = [b for b in small if b not in done]
    files = 0
    if new:
        folders = [f"{root}/batch={b}/day={day}" for b in new]
        size = sum(fs.getContentSummary(spark._jvm.org.apache.hadoop.fs.Path(f)).getLength() for f in folders)
        files = max(1, -(-size // file_bytes))
        target = f"{packed}/upto={new[-1]}"
        spark.read.text(folders).coalesce(files).write.text(target)
        _add(spark, f"{target}/_batches", "\n".join(new))
    for b in small:
        drop_folder(spark, f"{root}/batch={b}/day={day}")
    return files


def day_lines(spark: SparkSession, path: str, day: str) -> DataFrame:
    """Lines of one day: packed ones, and those of batches that are not packed yet."""
    root = path.rstrip("/")
    packed = [f"{root}/packed/day={day}/{n}" for n in _names(spark, f"{root}/packed/day={day}")]
    whole = [f for f in packed if "_batches" in _names(spark, f)]
    done = {b for f in whole for b in _read(spark, f"{f}/_batches").split()}
    loose = [f"{root}/{n}/day={day}" for n in _names(spark, root) if n.startswith("batch=") and n.removeprefix("batch=") not in done and f"day={day}" in _names(spark, f"{root}/{n}")]
    return spark.read.text([*whole, *loose]) if whole or loose else spark.createDataFrame([], "value string")


# ---- topics: sent once in effect ---------------------------------------------------------
def outbox_messages(df: DataFrame, batch: int, key: str, topic_column: str | None = None) -> DataFrame:
    """Messages with an id made of batch, topic, key and body, so that the same row of a batch bears the same id whenever it is sent; of equal rows the count tells them apart."""
    out = topic_messages(df, key, topic_column)
    if topic_column is None:
        out = out.withColumn("topic", F.lit(None).cast("string"))
    alike = out.groupBy("topic", "key", "value").agg(F.count(F.lit(1)).alias("_n"))  # equal rows are numbered by what they are, not by where they lie
    out = alike.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))).drop("_n")
    text = F.concat_ws("|", F.lit(str(batch)), F.coalesce("topic", F.lit("")), F.coalesce("key", F.lit("")), F.col("_i").cast("string"), "value")
    return out.select(F.sha2(text, 256).alias("message_id"), F.lit(batch).cast("bigint").alias("batch"), "topic", "key", "value")


def outbox_sink(path: str, send: Callable[[DataFrame], None], key: str, topic_column: str | None = None) -> Callable[[DataFrame, int], None]:
    """Each batch is first laid into the outbox, one folder per batch that a repeat replaces by the same, and sent from there with its message ids."""

    def each(df: DataFrame, number: int) -> None:
        folder = f"{path.rstrip('/')}/batch={number}"
        outbox_messages(df, number, key, topic_column).drop("batch").write.mode("overwrite").parquet(folder)
        send(df.sparkSession.read.parquet(folder))

    return each


def received_once(messages: DataFrame, delay: str | None = None, time: str = "timestamp") -> DataFrame:
    """What a topic holds without repeats: the first message of each id.  On a stream, ``delay`` bounds for how long after a message its repeat is known."""
    if not messages.isStreaming:
        return messages.dropDuplicates(["message_id"])
    if delay is None:
        raise ValueError("a stream needs a delay within which a repeated batch comes")
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark(["message_id"])

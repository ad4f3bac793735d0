"""Thin readers over files, topics and relational stores.

Every option, address and credential comes from the caller.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stratamart.functions.columns import SECOND


def json_table(spark: SparkSession, path: str, schema: str, corrupt: str | None = None) -> DataFrame:
    """JSON lines with a fixed schema; with ``corrupt`` unreadable lines are kept in that column."""
    reader = spark.read
    if corrupt:
        schema = f"{schema}, {corrupt} STRING"
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(schema).json(path)


def delimited_table(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = False, null: str = "") -> DataFrame:
    return spark.read.schema(schema).csv(path, sep=sep, header=header, nullValue=null, timestampFormat=SECOND)


# Relational column types and the table types they become; the rest become STRING.
RELATIONAL_TYPES = {
    "varchar": "STRING", "char": "STRING", "text": "STRING", "int": "INT", "tinyint": "INT", "bigint": "BIGINT", "decimal": "DECIMAL",
}


def table_type(relational: str) -> str:
    """``decimal(16,2)`` to ``DECIMAL(16,2)``, ``varchar(20)`` to ``STRING``."""
    found = re.match(r"\s*(\w+)\s*(\(\s*\d+\s*(?:,\s*\d+\s*)?\))?", relational.lower())
    base = RELATIONAL_TYPES.get(found.group(1), "STRING") if found else "STRING"
    if base == "DECIMAL":
        return "DECIMAL" + (found.group(2) or "(10,0)").replace(" ", "")
    return base


def schema_of_columns(columns: list[tuple[str, str]]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{name}` {table_type(kind)}" for name, kind in columns))


def copy_relational_schema(
    spark: SparkSession, options: Mapping[str, str], database: str, prefix: str = "ods_", partition: str = "dt", create: bool = True
) -> dict[str, str]:
    """A partitioned source table for every table of a relational database, from its column catalog.

    Only the catalog's rows reach the driver: one per column.
    """
    query = (
        "SELECT table_name, column_name, column_type, ordinal_position FROM information_schema.columns "
        f"WHERE table_schema = '{database}'"
    )
    rows = spark.read.format("jdbc").options(**options).option("query", query).load().orderBy("table_name", "ordinal_position").collect()
    tables: dict[str, list[tuple[str, str]]] = {}
    for name, column, kind, _ in rows:
        tables.setdefault(name, []).append((column, kind))
    statements = {}
    for name, columns in tables.items():
        body = ", ".join(f"`{c}` {table_type(k)}" for c, k in columns)
        statements[name] = f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({body}, {partition} STRING) USING parquet PARTITIONED BY ({partition})"
        if create:
            spark.sql(statements[name])
    return statements


def relational_query(spark: SparkSession, options: Mapping[str, str], query: str, camel: bool = False) -> DataFrame:
    """Rows of a query; ``camel`` turns ``user_id`` into ``userId``."""
    df = spark.read.format("jdbc").options(**options).option("query", query).load()
    return camel_columns(df) if camel else df


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[re.sub(r"_+(\w)", lambda m: m.group(1).upper(), c.lower()) for c in df.columns])


DEVICE_FIELDS = ("brand", "plat", "platv", "softv", "uname", "userkey", "datatype", "device", "ip", "net", "opa")


def device_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Device JSON lines as (good rows, unreadable lines)."""
    schema = ", ".join(f"{f} STRING" for f in DEVICE_FIELDS)
    lines = spark.read.text(path).select(
        "value", F.from_json("value", f"{schema}, _bad STRING", {"columnNameOfCorruptRecord": "_bad"}).alias("r")
    )
    good = lines.filter(F.col("r._bad").isNull()).select(*[F.col(f"r.{f}").alias(f) for f in DEVICE_FIELDS])
    return good, lines.filter(F.col("r._bad").isNotNull()).select("value")


def topic_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options) -> DataFrame:
    """A topic as a stream of text values.  Empty messages are left out."""
    raw = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", starting).options(**options).load()
    )
    return texts(raw)


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A folder of text files as a stream, one message per line."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return texts(reader.text(path))


def texts(df: DataFrame) -> DataFrame:
    value = F.col("value").cast("string")
    return df.filter(value.isNotNull()).select(value.alias("value"))


def json_topic(stream: DataFrame, schema: str) -> DataFrame:
    """Columns of a stream of JSON texts."""
    return stream.select(F.from_json("value", schema).alias("r")).select("r.*")


def keyed_row(table: DataFrame, key, key_column: str = "row_key") -> DataFrame:
    """Point lookup by the md5 of a key."""
    return table.filter(F.col(key_column) == F.md5(F.lit(str(key))))


def rows_as_json(table: DataFrame, limit: int) -> DataFrame:
    """The first rows of a table as JSON texts, in key order."""
    return table.orderBy(*table.columns[:1]).limit(limit).select(F.to_json(F.struct("*")).alias("value"))

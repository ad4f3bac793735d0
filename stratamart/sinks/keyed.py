"""Tables of current rows by key.

Rows lie in buckets by a hash of the key.  A load reads the buckets it touches, writes them anew to a folder of its own and then adds a
manifest, a small file that says in which folder each bucket lies.  Adding the manifest is one rename: before it the table is the old one, after it the new
one, and a load that fails on the way leaves nothing but a folder that no manifest names.  There is one writer at a time.

The number of buckets follows the table: it doubles when buckets hold more than ``BUCKET_ROWS`` rows on average, so a small load touches a bounded
share of a large table however large that grows.

    folder/manifest-00000012.json    {"buckets", "by", "schema", "held": {bucket: [folder, rows]}}
    folder/data-<id>/_bucket=17/     rows with _version and _deleted
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stratamart.operators.merge import latest_per_key

# Columns that a table of current rows keeps beside its own.
BUCKET, VERSION, DELETED = "_bucket", "_version", "_deleted"
#: Rows of a bucket, on average, up to which the number of buckets stays; buckets of a new table; folders of old versions kept for their readers.
BUCKET_ROWS, FIRST_BUCKETS, KEPT_VERSIONS = 1_000_000, 16, 3


# ---- folders, on whatever file system the path names ----------------------------------
def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def _read(spark: SparkSession, path: str) -> str:
    fs, hadoop = _fs(spark, path)
    stream = fs.open(hadoop)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _add(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that appears whole or not at all, and never in the place of another."""
    fs, hadoop = _fs(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{hadoop.getParent().toString()}/_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(hadoop) or not fs.rename(draft, hadoop):
        fs.delete(draft, False)
        raise RuntimeError(f"{path} is there already: another load wrote this table at the same time")


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop = _fs(spark, path)
    fs.delete(hadoop, True)


@dataclass
class Manifest:
    number: int
    buckets: int
    by: list[str]
    schema: T.StructType
    held: dict[int, tuple[str, int]]

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.held.values())


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The table as it is now; None before the first load."""
    found = [n for n in _names(spark, path) if re.fullmatch(r"manifest-\d+\.json", n)]
    if not found:
        return None
    m = json.loads(_read(spark, f"{path.rstrip('/')}/{found[-1]}"))
    held = {int(b): (folder, rows) for b, (folder, rows) in m["held"].items()}
    return Manifest(int(found[-1][9:-5]), m["buckets"], m["by"], T.StructType.fromJson(m["schema"]), held)


def _save(spark: SparkSession, path: str, now: Manifest) -> None:
    body = {"buckets": now.buckets, "by": now.by, "schema": json.loads(now.schema.json()), "held": {str(b): list(h) for b, h in now.held.items()}}
    _add(spark, f"{path.rstrip('/')}/manifest-{now.number:08d}.json", json.dumps(body))
    old = [n for n in _names(spark, path) if re.fullmatch(r"manifest-\d+\.json", n)][:-KEPT_VERSIONS]
    for name in old:
        drop_folder(spark, f"{path.rstrip('/')}/{name}")
    if old:  # folders that none of the kept manifests names
        named = {f for n in _names(spark, path) if n.startswith("manifest-") for f, _ in json.loads(_read(spark, f"{path.rstrip('/')}/{n}"))["held"].values()}
        for name in _names(spark, path):
            if name.startswith("data-") and name not in named:
                drop_folder(spark, f"{path.rstrip('/')}/{name}")


def _rows(spark: SparkSession, path: str, now: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
    """Stored rows of some buckets (all by default), flagged ones included."""
    wanted = now.held if buckets is None else [b for b in buckets if b in now.held]
    folders = [f"{path.rstrip('/')}/{now.held[b][0]}/{BUCKET}={b}" for b in wanted]
    return spark.read.schema(now.schema).parquet(*folders) if folders else spark.createDataFrame([], now.schema)


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows with their version and flag; None before the first load."""
    now = manifest(spark, path)
    return None if now is None else _rows(spark, path, now)


def current_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a merged table that are not deleted."""
    rows = stored_rows(spark, path)
    if rows is None:
        raise FileNotFoundError(f"nothing has been merged into {path} yet")
    return rows.filter(~F.col(DELETED)).drop(VERSION, DELETED)


def _bucket(by: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")


def rows_of(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame | None:
    """Current rows whose bucketing columns are among ``keys`` (distinct); reads the buckets of these alone."""
    now = manifest(spark, path)
    if now is None:
        return None
    touched = [r[0] for r in keys.select(_bucket(now.by, now.buckets).alias("b")).distinct().collect()]  # at most ``buckets`` numbers
    found = _rows(spark, path, now, touched).filter(~F.col(DELETED)).drop(VERSION, DELETED)
    same = [found[c].eqNullSafe(keys[c]) for c in now.by]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return found.join(keys, on, "left_semi")


def _write(spark: SparkSession, path: str, rows: DataFrame, now: Manifest | None, touched: Sequence[int], buckets: int, by: Sequence[str], schema: T.StructType) -> None:
    """Replace the touched buckets by ``rows`` (with their bucket); the others stay where they are."""
    folder = f"data-{uuid.uuid4().hex}"
    target = f"{path.rstrip('/')}/{folder}"
    rows.select(*schema.names, BUCKET).repartition(F.col(BUCKET)).write.partitionBy(BUCKET).parquet(target)
    held = {} if now is None else {b: h for b, h in now.held.items() if b not in set(touched)}
    counts = spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(target).groupBy(BUCKET).count().collect()
    held |= {r[BUCKET]: (folder, r["count"]) for r in counts}
    _save(spark, path, Manifest(1 if now is None else now.number + 1, buckets, list(by), schema, held))


def _open(schema: T.StructType) -> T.StructType:
    """The same columns, none of which refuses nulls at any depth."""
    return T.StructType.fromJson(json.loads(schema.json().replace('"nullable":false', '"nullable":true').replace('ContainsNull":false', 'ContainsNull":true').replace('containsNull":false', 'containsNull":true')))


def _wider(old: T.StructType, new: T.StructType, spark: SparkSession) -> T.StructType:
    """The columns of both; where their types differ, the type that holds both."""
    return _open(spark.createDataFrame([], old).unionByName(spark.createDataFrame([], _open(new)), allowMissingColumns=True).schema)


def merge_rows(
    df: DataFrame, path: str, keys: Sequence[str], version: Sequence[str] = (), deleted: Column | None = None, buckets: int | None = None, by: Sequence[str] | None = None
) -> None:
    """Merge rows into a table of current rows by key.

    Only the buckets that ``df`` touches are read and written.  The newest row of each key by ``version`` (columns of ``df``) stays.  At one version a deletion
    beats a row, and an incoming row a stored one.  A deleted key stays as a flagged row with its version, also if no row of it has come yet, so neither a
    repeated batch nor a late older row brings it back; ``forget_deleted`` drops such rows when their time is over.  Merging a batch again changes nothing.

    ``by``: key columns by whose hash rows are dealt to buckets, all by default; ``buckets``: their number, if it shall not follow the table's size.
    New columns are null in older rows.
    """
    spark = df.sparkSession
    by = list(by or keys)
    now = manifest(spark, path)
    if now is not None and now.by != by:
        raise ValueError(f"{path} is dealt to buckets by {now.by}, not by {by}")
    rest = [c for c in df.columns if c not in keys]
    at = F.struct(*version) if version else F.struct(F.lit(0).alias("at"))
    rows = df.select(*keys, *rest, at.alias(VERSION), F.coalesce(deleted if deleted is not None else F.lit(False), F.lit(False)).alias(DELETED))
    newest = rows.withColumn("_new", F.lit(True))
    schema = _open(rows.schema) if now is None else _wider(now.schema, rows.schema, spark)
    order = [VERSION, DELETED, "_new"]
    newest = latest_per_key(newest, keys, order).persist()
    try:
        incoming = newest.count()
        if not incoming:
            return
        total = incoming + (now.rows if now else 0)
        count = now.buckets if now else (buckets or FIRST_BUCKETS)
        while buckets is None and total > count * BUCKET_ROWS:
            count *= 2
        grown = now is not None and count != now.buckets
        bucket = _bucket(by, count).alias(BUCKET)
        touched = list(now.held) if grown else [r[0] for r in newest.select(bucket).distinct().collect()]  # at most ``count`` numbers
        both = newest
        if now is not None:
            old = _rows(spark, path, now, touched).withColumn("_new", F.lit(False))
            both = newest.unionByName(old, allowMissingColumns=True)
            both = latest_per_key(both, keys, order)
        both = both.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], bucket)
        _write(spark, path, both, now, touched, count, by, schema)
    finally:
        newest.unpersist()


def delete_rows(keys_gone: DataFrame, path: str, keys: Sequence[str], version: Mapping[str, object]) -> None:
    """Delete keys as of a version, whether a row of theirs has come yet or not."""
    at = [F.lit(v).cast("bigint").alias(c) if isinstance(v, int) else F.lit(v).alias(c) for c, v in version.items()]
    merge_rows(keys_gone.select(*keys, *at), path, keys, list(version), F.lit(True))


def forget_deleted(spark: SparkSession, path: str, before: Column) -> None:
    """Drop flagged rows whose version satisfies ``before``: the stated retention has passed.  A bucket that ends empty leaves the manifest."""
    now = manifest(spark, path)
    if now is None:
        return
    gone = F.col(DELETED) & F.coalesce(before, F.lit(False))
    rows = _rows(spark, path, now).withColumn(BUCKET, _bucket(now.by, now.buckets))
    touched = [r[0] for r in rows.filter(gone).select(BUCKET).distinct().collect()]
    if touched:
        rows = _rows(spark, path, now, touched).withColumn(BUCKET, _bucket(now.by, now.buckets))
        _write(spark, path, rows.filter(~gone), now, touched, now.buckets, now.by, now.schema)


def replace_rows(rows: DataFrame, touched: DataFrame, path: str, keys: Sequence[str], by: Sequence[str]) -> None:
    """Put ``rows`` in the place of all rows whose ``by`` columns are among ``touched`` (distinct): what is not made any more goes.

    For tables that are made anew from kept ones, so no versions and no flags: a repeated batch replaces rows by the same ones.
    """
    spark = rows.sparkSession
    now = manifest(spark, path)
    if now is not None and now.by != list(by):
        raise ValueError(f"{path} is dealt to buckets by {now.by}, not by {list(by)}")
    made = rows.select("*", F.struct(F.lit(0).alias("at")).alias(VERSION), F.lit(False).alias(DELETED)).persist()
    try:
        incoming = made.count()
        total = incoming + (now.rows if now else 0)
        count = now.buckets if now else FIRST_BUCKETS
        while total > count * BUCKET_ROWS:
            count *= 2
        schema = _open(made.schema) if now is None else _wider(now.schema, made.schema, spark)
        bucket = _bucket(by, count).alias(BUCKET)
        if now is not None and count != now.buckets:
            reached = list(now.held)
        else:
            reached = [r[0] for r in touched.select(*by).select(bucket).distinct().collect()]
        if not reached and not incoming:
            return
        both = made
        if now is not None:
            old = _rows(spark, path, now, reached)
            same = [old[c].eqNullSafe(touched[c]) for c in by]
            on = same[0]
            for s in same[1:]:
                on = on & s
            both = made.unionByName(old.join(touched, on, "left_anti"), allowMissingColumns=True)
        both = both.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], bucket)
        _write(spark, path, both, now, reached, count, by, schema)
    finally:
        made.unpersist()

"""The real-time jobs: sources in, sinks out.

Inputs are streams of JSON texts (``value``), from files or topics alike.  Keyed
sinks take the newest version per key in each micro-batch, so a restarted batch
changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart.functions.columns import millis_to_ts, money
from stratamart.operators.cdc import LOG_POSITION, became, decode, fields, increase, kept_side, log_position, of_table, routed_to_dimensions
from stratamart.operators.logs import parse, split
from stratamart.operators.merge import latest_per_key, stack_sums
from stratamart.operators.versions import as_of, validity_ranges
from stratamart.plans import realtime
from stratamart.session import tune_streams
from stratamart.sinks.keyed import stored_rows
from stratamart.sinks.tables import merge_rows, topic_messages
from stratamart.streaming.touched import Side, by_touched_keys, deltas_by_touched_keys, summed_deltas
from stratamart.streaming.visitors import repaired


def run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append", trigger: dict | None = None):
    """Start a query that hands each micro-batch to ``each``; by default it takes what is there and ends.  State lies in RocksDB."""
    tune_streams(stream.sparkSession)
    return (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(each).start()
    )


def write_routes(path: str) -> Callable[[DataFrame, int], None]:
    """Write a batch by its ``route``, in one pass; a repeated batch replaces itself."""

    def each(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "route").json(path)

    return each


# ---- logs ---------------------------------------------------------------------
def log_split_job(logs: DataFrame, path: str, checkpoint: str, zone: str, ttl_ms: int | None = None):
    """Log lines to error, start, display, action, page and dirty events, with repaired new-visitor flags.

    A line is parsed once.  First visits are kept in a merged table beside the checkpoint; ``ttl_ms`` forgets a device that was not seen for so long.
    """
    sink = write_routes(path)

    def each(batch: DataFrame, number: int) -> None:
        lines = batch.persist()
        try:
            sink(split(repaired(lines, f"{checkpoint}/first_visits", zone, ttl_ms)).select("route", "value", "mid", "ts", "is_new"), number)
        finally:
            lines.unpersist()

    return run(parse(logs), f"{checkpoint}/events", each)


def typed_log_job(logs: DataFrame, path: str, checkpoint: str):
    """Log lines by type, with a full copy of the readable ones."""
    from stratamart.plans.refund import rf_log_route

    return run(rf_log_route(logs), f"{checkpoint}/typed", write_routes(path))


# ---- dimensions -----------------------------------------------------------------
def current_config(changes: DataFrame) -> DataFrame:
    """The routing table after a series of changes to it: the newest row per source table, deletes gone."""
    at = log_position() if "source" in changes.columns else [F.col("ts_ms")]
    rows = changes.select("op", *at, kept_side().alias("row"))
    order = [c for c in rows.columns if c not in ("op", "row")]
    named = rows.select("op", *order, (F.col("op") == "d").alias("gone"), *[F.col("row")[c].alias(c) for c in ("source_table", "sink_table", "sink_columns", "sink_row_key")])
    return latest_per_key(named, ["source_table"], [*order, "gone"]).filter(F.col("op") != "d").drop("gone", *order[1:])


CELL_KEYS = ["sink_table", "row_key", "column_name"]


def dimension_job(cdc: DataFrame, config: Callable[[], DataFrame], path: str, checkpoint: str):
    """Changes to dimension cells; the routing table is read again for every micro-batch."""

    def each(batch: DataFrame, number: int) -> None:
        cells = routed_to_dimensions(decode(batch), config()).select(*CELL_KEYS, "column_value", "op", *LOG_POSITION)
        merge_rows(cells, path, CELL_KEYS, LOG_POSITION)

    return run(cdc, checkpoint, each)


def apply_table_lifecycle(spark: SparkSession, config_changes: DataFrame, prefix: str = "") -> list[str]:
    """Create, drop or re-create dimension tables as their routing rows change.

    The routing table has one row per dimension, so its changes are few.
    """
    changes = config_changes.select("op", "ts_ms", kept_side()["sink_table"].alias("t"), kept_side()["sink_columns"].alias("c"))
    # What is gathered is one row per dimension: its newest change, and whether any of its changes altered it.
    newest = changes.groupBy("t").agg(F.max_by(F.struct("op", "c"), F.struct("ts_ms", F.col("op") == "d")).alias("last"), F.bool_or(F.col("op").isin("u", "d")).alias("altered"))
    rows = newest.select(F.when((F.col("last.op") == "c") & F.col("altered"), F.lit("u")).otherwise(F.col("last.op")), F.lit(None), "t", "last.c").orderBy("t").collect()
    done = []
    for op, _, table, columns in rows:
        name = f"{prefix}{table}"
        if op in ("d", "u"):
            done.append(f"DROP TABLE IF EXISTS {name}")
        if op != "d":
            body = ", ".join(["`row_key` STRING", *[f"`{c}` STRING" for c in columns.split(",")]])
            done.append(f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING parquet")
    for statement in done:
        spark.sql(statement)
    return done


# ---- detail -----------------------------------------------------------------------
@contextmanager
def one_clock(spark: SparkSession):
    """For queries whose inputs are all cut from one stream.

    By default the slowest input holds the watermark, so a table without changes
    would hold it for ever.  When all inputs are parts of one stream, the
    fastest one tells the time.  The query keeps the choice it was started with.
    """
    name = "spark.sql.streaming.multipleWatermarkPolicy"
    before = spark.conf.get(name, "min")
    spark.conf.set(name, "max")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def order_detail_job(spark: SparkSession, cdc: DataFrame, path: str, checkpoint: str, **options):
    """Order detail rows, upserted by line."""
    with one_clock(spark):
        return run(order_detail_stream(cdc, **options), checkpoint, lambda batch, n: merge_rows(batch.select(*realtime.DETAIL), path, ["id"], ["ts_ms"]))


def order_detail_stream(cdc: DataFrame, delay: str = "5 seconds", spread: str = "10 minutes") -> DataFrame:
    """Order lines with order, activity and coupon, from one change stream.

    The four rows of an order are written together, so they are joined within
    ``spread`` of the line; that bounds the state, and a line without promotion
    leaves once the watermark has passed its spread.  Start it under ``one_clock``.
    """

    def side(df, time):
        return df.withColumn(time, millis_to_ts("ts_ms" if "ts_ms" in df.columns else time)).withWatermark(time, delay)

    def of(table, names, key, alias, time):
        rows = of_table(decode(cdc), table).filter(F.col("op").isin("c", "r"))
        return rows.select(F.col("after")[key].alias(alias), *fields(names), millis_to_ts("ts_ms").alias(time)).withWatermark(time, delay)

    def near(time):
        gap = F.expr(f"INTERVAL {spread}")
        return (F.col(time) >= F.col("line_time") - gap) & (F.col(time) <= F.col("line_time") + gap)

    lines = side(realtime._new_lines(decode(cdc)), "line_time")
    orders = of("order_info", ["user_id", "province_id"], "id", "o_id", "order_time")
    activity = of("order_detail_activity", ["activity_id", "activity_rule_id"], "order_detail_id", "a_id", "activity_time")
    coupon = of("order_detail_coupon", ["coupon_id"], "order_detail_id", "c_id", "coupon_time")
    joined = (
        lines.join(orders, (F.col("order_id") == F.col("o_id")) & near("order_time"))
        .join(activity, (F.col("id") == F.col("a_id")) & near("activity_time"), "left")
        .join(coupon, (F.col("id") == F.col("c_id")) & near("coupon_time"), "left")
    )
    return joined.withColumn("date_id", millis_to_ts("create_time").cast("date")).select(*realtime.DETAIL, "line_time")


def pay_suc_stream(lines: DataFrame, cdc: DataFrame, dictionary: DataFrame | None = None, delay: str = "5 seconds") -> DataFrame:
    """Interval join of order lines (columns of the detail table) and successful payments.

    A dictionary given here is bound for the life of the query; without one the rows go out with their code, for ``named_as_of`` to name per micro-batch.
    """
    timed = lines.withColumn("line_time", millis_to_ts("ts_ms")).withWatermark("line_time", delay)
    payments = realtime.paid(decode(cdc)).withWatermark("pay_time", delay)
    if dictionary is None:
        return realtime.matched_payments(timed, payments)
    return realtime.paid_lines(timed, payments, dictionary)


def dictionary_changes(cdc: DataFrame, table: str = "base_dic") -> DataFrame:
    """Changes of the code dictionary, as rows to be kept: one per code and change."""
    row = kept_side()
    rows = of_table(decode(cdc), table).select(*[row[c].alias(c) for c in ("dic_code", "parent_code", "dic_name")], (F.col("op") == "d").alias("gone"), *log_position())
    return rows.filter(F.col("dic_code").isNotNull())


def keep_dictionary(batch: DataFrame, path: str) -> None:
    """Add a micro-batch's dictionary changes to the kept versions."""
    merge_rows(dictionary_changes(batch), path, ["dic_code", "parent_code", *LOG_POSITION])


def named_as_of(rows: DataFrame, path: str, code: str, label: str, parent: str, time: str = "ts_ms", how: str = "inner") -> DataFrame:
    """Rows with the name that their code had at their own time, from the dictionary versions kept at ``path``."""
    kept = stored_rows(rows.sparkSession, path)
    if kept is None:
        named = rows.withColumn(label, F.lit(None).cast("string"))
        return named if how == "left" else named.limit(0)
    kept = kept.filter((F.col("parent_code") == parent) | F.col("gone"))
    ranges = validity_ranges(kept.select("dic_code", "ts_ms", "dic_name", "gone", *LOG_POSITION[1:]), ["dic_code"], "ts_ms", LOG_POSITION[1:], F.col("gone"))
    return as_of(rows, ranges, {code: "dic_code"}, time, {"dic_name": label}, how=how)


def comment_job(cdc: DataFrame, path: str, checkpoint: str):
    """Comments with the name that their appraisal had when they were made.

    A batch's dictionary changes are kept before its comments are named, so a dictionary that changes halfway names each comment by its own time.  A change that comes after
    comments of its time were named does not name them again.
    """

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            keep_dictionary(batch, f"{path}/dictionary")
            rows = of_table(decode(batch), "comment_info").select(*fields(["id", "user_id", "sku_id", "appraise", "comment_txt"]), "ts_ms")
            named = named_as_of(rows, f"{path}/dictionary", "appraise", "appraise_name", "12")
            merge_rows(named.withColumn("appraise_key", F.md5("appraise")), f"{path}/result", ["id"], ["ts_ms"])
        finally:
            batch.unpersist()

    return run(cdc, checkpoint, each)


# Detail rows and captured changes travel in one stream, so that a batch holds both.
def with_lines(lines: DataFrame, cdc: DataFrame) -> DataFrame:
    """One stream of detail rows (``line``) and change texts (``value``)."""
    line = F.struct(*realtime.DETAIL)
    return lines.select(line.alias("line"), F.lit(None).cast("string").alias("value")).unionByName(cdc.select(F.lit(None).cast(lines.select(line.alias("l")).schema["l"].dataType).alias("line"), "value"))


def _lines_of(batch: DataFrame) -> DataFrame:
    return batch.filter("line is not null").select("line.*")


def _changes_of(batch: DataFrame) -> DataFrame:
    """Decoded changes with a mark of their own text, by which a repeated message is known."""
    return decode(batch.filter("value is not null").select("value", F.sha2("value", 256).alias("message")))


def order_cancel_job(lines: DataFrame, cdc: DataFrame, path: str, checkpoint: str):
    """Lines of cancelled orders, however late the cancel or the line comes."""
    sides = {
        "lines": Side(_lines_of, ["order_id", "id"]),
        "cancels": Side(lambda b: realtime.cancelled(_changes_of(b)).withColumnRenamed("cancel_order_id", "order_id"), ["order_id", "cancel_ts_ms"], ["cancel_ts_ms"]),
    }

    def build(lines: DataFrame, cancels: DataFrame) -> DataFrame:
        return realtime.cancelled_lines(lines, cancels.withColumnRenamed("order_id", "cancel_order_id"))

    return run(with_lines(lines, cdc), checkpoint, by_touched_keys(path, sides, ["order_id"], build, ["order_id", "id", "ts_ms"]))


def _states(state) -> Side:
    """Places of orders at changes of their state."""
    return Side(lambda b: realtime.order_places(decode(b), state).withColumnRenamed("state_order_id", "order_id"), ["order_id", "state_at"], ["state_at"])


def refund_job(cdc: DataFrame, path: str, checkpoint: str, name: Callable[[DataFrame], DataFrame]):
    """Refunds asked for, with the order's change of state, however far apart; ``name`` adds the labels."""
    sides = {"refunds": Side(lambda b: realtime.refunds_asked(decode(b)), ["order_id", "id"]), "orders": _states(realtime.refunding())}

    def build(refunds: DataFrame, orders: DataFrame) -> DataFrame:
        return name(realtime.matched_refunds(refunds, orders.withColumnRenamed("order_id", "state_order_id")))

    return run(cdc, checkpoint, by_touched_keys(path, sides, ["order_id"], build, ["order_id", "id"]))


def refund_pay_job(cdc: DataFrame, path: str, checkpoint: str, name: Callable[[DataFrame], DataFrame]):
    """Refund payments, with the refund and the order that end with them, however far apart; ``name`` adds the labels."""
    sides = {
        "payments": Side(lambda b: realtime.refund_payments(decode(b)), ["order_id", "id"]),
        "refunds": Side(lambda b: realtime.refunds_done(decode(b)).withColumnRenamed("done_order_id", "order_id"), ["order_id", "done_sku_id", "done_at"], ["done_at"]),
        "orders": _states(became("order_status", "1006")),
    }

    def build(payments: DataFrame, refunds: DataFrame, orders: DataFrame) -> DataFrame:
        return name(realtime.matched_refund_payments(payments, refunds.withColumnRenamed("order_id", "done_order_id"), orders.withColumnRenamed("order_id", "state_order_id")))

    return run(cdc, checkpoint, by_touched_keys(path, sides, ["order_id"], build, ["order_id", "id"]))


def detail_job(spark: SparkSession, stream: DataFrame, path: str, checkpoint: str, keys: list[str], name: Callable[[DataFrame], DataFrame] = lambda rows: rows):
    """Detail rows upserted by key, with the time of their processing.  ``name`` adds labels; it runs per micro-batch, so it can read the dictionary anew."""

    def each(batch: DataFrame, number: int) -> None:
        merge_rows(name(batch).withColumn("proc_time", F.current_timestamp()), path, keys, ["ts_ms"])

    with one_clock(spark):
        return run(stream, checkpoint, each)


def topic_sink(write: Callable[[DataFrame], None], key: str | None = None, version: str | None = None, topic_column: str | None = None) -> Callable[[DataFrame, int], None]:
    """Rows as messages to one topic or to the topic each row names; with ``version`` only the newest row of a key is sent.

    ``write`` takes the messages: ``sinks.tables.write_topic``, or a file sink.
    """

    def each(batch: DataFrame, number: int) -> None:
        write(topic_messages(latest_per_key(batch, [key], [version]) if key and version else batch, key, topic_column))

    return each


# ---- summaries ------------------------------------------------------------------------
def once(df: DataFrame, keys: list[str], time: str | None, delay: str) -> DataFrame:
    """Rows delivered twice count once; with an event time the memory of them is bounded."""
    if time is None:
        return df.dropDuplicates(keys)
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def interaction_user_stream(carts: DataFrame, comments: DataFrame) -> DataFrame:
    return realtime.rt_dws_interaction_user(carts, comments)


def province_stream(lines: DataFrame) -> DataFrame:
    """Orders and amounts per province and day.

    A stream cannot count distinct orders, so the first line of each order is
    sent once more as an order; orders and lines are then summed together.
    """
    keys = ["province_id", "date_id"]
    orders = lines.dropDuplicates([*keys, "order_id"]).select(*keys, F.lit(1).alias("order_count"))
    amounts = lines.select(
        *keys, F.col("sku_num").cast("bigint").alias("order_num"), *[money(c, 16).alias(n) for n, c in realtime.AMOUNTS.items()]
    )
    measures = {"order_count": "bigint", "order_num": "bigint", **{n: "decimal(28,2)" for n in realtime.AMOUNTS}}
    return stack_sums(keys, [orders, amounts], measures)


def user_goods_job(lines: DataFrame, cdc: DataFrame, path: str, checkpoint: str, dictionary: Callable[[], DataFrame]):
    """Orders of a user for a product and day, with all carts and comments of the two: the table of ``rt_dws_user_goods``, kept up by retraction.

    A cart or comment changes the rows of all order days of its user and product, so these are made anew from the kept sides.
    """
    pair = ["user_id", "sku_id"]

    def carts(batch: DataFrame) -> DataFrame:
        rows = of_table(_changes_of(batch), "cart_info").select(*fields(["id", *pair]), increase("sku_num").alias("sku_num"), "ts_ms", "message")
        return rows.filter(F.col("sku_num").isNotNull())

    sides = {
        "lines": Side(_lines_of, [*pair, "order_id", "id"]),
        "carts": Side(carts, [*pair, "message"]),
        "comments": Side(lambda b: realtime.rt_dwd_comment(_changes_of(b), dictionary()), [*pair, "id", "ts_ms"]),
    }
    return run(with_lines(lines, cdc), checkpoint, by_touched_keys(path, sides, pair, lambda lines, carts, comments: realtime.rt_dws_user_goods(lines, carts, comments), [*pair, "date_id"]))


PROVINCE_DAY, PROVINCE_MEASURES = ["province_id", "date_id"], ["order_count", "order_num", *realtime.AMOUNTS]


def province_job(lines: DataFrame, path: str, checkpoint: str, name: str):
    """Orders and amounts per province and day, exact at any lateness and without streaming state.

    An order counts once in its day, whatever number of its lines come and when; ``name`` tells this checkpoint from others.  ``province_totals`` reads the sums.
    """

    def orders(lines: DataFrame) -> DataFrame:
        amounts = [F.sum(money(c, 16)).alias(n) for n, c in realtime.AMOUNTS.items()]
        per_order = lines.groupBy("order_id", *PROVINCE_DAY).agg(F.sum(F.col("sku_num").cast("bigint")).alias("order_num"), *amounts)
        return per_order.withColumn("order_count", F.lit(1).cast("bigint"))

    sides = {"lines": Side(lambda b: b.select(*realtime.DETAIL), ["order_id", "id"])}
    return run(lines, checkpoint, deltas_by_touched_keys(path, sides, ["order_id"], orders, PROVINCE_DAY, PROVINCE_MEASURES, name))


def province_totals(spark: SparkSession, path: str) -> DataFrame:
    return summed_deltas(spark, path, PROVINCE_DAY, PROVINCE_MEASURES).filter("order_count > 0")


def keyed_sink(path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """Upsert of an aggregate in update mode: what comes later wins, also after a new checkpoint."""
    return lambda batch, number: merge_rows(batch, path, keys)


def summary_job(stream: DataFrame, path: str, keys: list[str], checkpoint: str, trigger: dict | None = None):
    return run(stream, checkpoint, keyed_sink(path, keys), "update", trigger)


def relational_sink(write: Callable[[DataFrame], None], keys: list[str], version: str | None = None) -> Callable[[DataFrame, int], None]:
    """Sync to a relational table: the newest row per key of each batch goes to ``write``, which upserts."""

    def each(batch: DataFrame, number: int) -> None:
        write(latest_per_key(batch, keys, [version]) if version else batch.dropDuplicates(keys))

    return each


def lake_job(cdc: DataFrame, table: str, columns: list[str], path: str, checkpoint: str, key: str = "id"):
    """One captured table as a table of current rows that follows inserts, updates and deletes in the order of the log."""

    def each(batch: DataFrame, number: int) -> None:
        row = kept_side()
        rows = of_table(decode(batch), table).select(*[row[c].alias(c) for c in columns], "op", *log_position())
        merge_rows(rows, path, [key], LOG_POSITION, F.col("op") == "d")

    return run(cdc, checkpoint, each)

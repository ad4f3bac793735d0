"""Real-time retail tables.

The detail tables take decoded change rows and work on batches and streams
alike.  Summaries put all their facts on one grain by union and one aggregate,
which streams allow, where a join of aggregates is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.functions.columns import day_of, millis_to_ts, money, money_product
from stratamart.operators.cdc import LOG_POSITION, became, decode, fields, increase, log_position, of_table, routed_to_dimensions, turned
from stratamart.operators.logs import parse, repair_is_new, split
from stratamart.operators.lookups import with_label
from stratamart.operators.merge import latest_per_key, stack_sums
from stratamart.warehouse import plan

GOOD_COMMENT = "1201"
DETAIL = [
    "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id", "coupon_id", "date_id",
    "create_time", "sku_num", "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount", "ts_ms",
]


@plan
def cdc_changes(ods_cdc):
    return decode(ods_cdc)


# ---- dimension routing and log split ------------------------------------------
@plan
def rt_cdc_to_dim(cdc_changes, ods_dim_config):
    """Current cell values of the dimension store."""
    cells = routed_to_dimensions(cdc_changes, ods_dim_config)
    return latest_per_key(cells, ["sink_table", "row_key", "column_name"], [*LOG_POSITION, "op"]).select(
        "sink_table", "row_key", "column_name", "column_value"
    )


@plan
def rt_log_split(ods_log, zone):
    return split(repair_is_new(parse(ods_log, "log"), zone))


# ---- detail tables -----------------------------------------------------------------
@plan
def rt_dwd_comment(cdc_changes, ods_base_dic):
    comments = of_table(cdc_changes, "comment_info").select(*fields(["id", "user_id", "sku_id", "appraise", "comment_txt"]), "ts_ms")
    named = with_label(comments, ods_base_dic, "appraise", "appraise_name", parent="12", how="inner")
    return named.select("id", "user_id", "sku_id", "appraise", F.md5("appraise").alias("appraise_key"), "appraise_name", "comment_txt", "ts_ms")


@plan
def rt_dwd_cart_add(cdc_changes):
    added = of_table(cdc_changes, "cart_info").select(*fields(["id", "user_id", "sku_id"]), increase("sku_num").alias("sku_num"), "ts_ms")
    return added.filter(F.col("sku_num").isNotNull())


def _new_lines(changes: DataFrame) -> DataFrame:
    return of_table(changes, "order_detail").filter(F.col("op").isin("c", "r")).select(
        *fields(["id", "order_id", "sku_id", "sku_name", "create_time", "sku_num", "split_total_amount", "split_activity_amount", "split_coupon_amount"]),
        money_product(F.col("after")["sku_num"], F.col("after")["order_price"]).alias("split_original_amount"), "ts_ms",
    )


def _new_orders(changes: DataFrame) -> DataFrame:
    return of_table(changes, "order_info").filter(F.col("op").isin("c", "r")).select(
        F.col("after")["id"].alias("order_id"), *fields(["user_id", "province_id"])
    )


@plan
def rt_dwd_order_detail(cdc_changes):
    """Order lines with their order, and the activity and coupon if any."""
    activity = of_table(cdc_changes, "order_detail_activity").select(
        F.col("after")["order_detail_id"].alias("id"), *fields(["activity_id", "activity_rule_id"])
    )
    coupon = of_table(cdc_changes, "order_detail_coupon").select(F.col("after")["order_detail_id"].alias("id"), *fields(["coupon_id"]))
    lines = _new_lines(cdc_changes).join(_new_orders(cdc_changes), "order_id")
    joined = lines.join(activity, "id", "left").join(coupon, "id", "left")
    return joined.withColumn("date_id", day_of(millis_to_ts("create_time"))).select(*DETAIL)


def cancelled(changes: DataFrame) -> DataFrame:
    return of_table(changes, "order_info").filter(turned("order_status", "1001", "1003")).select(
        F.col("after")["id"].alias("cancel_order_id"), F.col("after")["operate_time"].alias("cancel_time"), F.col("ts_ms").alias("cancel_ts_ms"),
        millis_to_ts("ts_ms").alias("cancel_at"),
    )


def cancelled_lines(lines: DataFrame, cancels: DataFrame) -> DataFrame:
    """Lines of cancelled orders."""
    kept = [c for c in DETAIL if c not in ("date_id", "create_time", "ts_ms")]
    return lines.join(cancels, F.col("order_id") == F.col("cancel_order_id")).select(
        *kept, F.substring("cancel_time", 1, 10).alias("date_id"), "cancel_time", F.col("cancel_ts_ms").alias("ts_ms")
    )


@plan
def rt_dwd_order_cancel(rt_dwd_order_detail, cdc_changes):
    return cancelled_lines(rt_dwd_order_detail, cancelled(cdc_changes))


def paid(changes: DataFrame) -> DataFrame:
    return of_table(changes, "payment_info").filter(F.col("after")["payment_status"] == "1602").select(
        *fields(["order_id", "payment_type", "callback_time"]), F.col("ts_ms").alias("pay_ts_ms"), millis_to_ts("ts_ms").alias("pay_time")
    )


def within_payment_window():
    """An order line belongs to a payment made up to 30 minutes after it, or 5 seconds before."""
    return (F.col("line_time") >= F.col("pay_time") - F.expr("INTERVAL 30 MINUTES")) & (
        F.col("line_time") <= F.col("pay_time") + F.expr("INTERVAL 5 SECONDS")
    )


def matched_payments(lines: DataFrame, payments: DataFrame) -> DataFrame:
    """Interval join of order lines (with ``line_time``) and payments (with ``pay_time``)."""
    pay = payments.withColumnRenamed("order_id", "pay_order_id")
    return lines.join(pay, (F.col("order_id") == F.col("pay_order_id")) & within_payment_window())


def paid_lines(lines: DataFrame, payments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Paid lines with the name of the payment type."""
    return paid_columns(with_label(matched_payments(lines, payments), dictionary, "payment_type", "payment_type_name", parent="11", how="inner"))


def paid_columns(named: DataFrame) -> DataFrame:
    return named.select(
        F.col("id").alias("order_detail_id"), "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
        "coupon_id", F.col("payment_type").alias("payment_type_code"), "payment_type_name", "callback_time", "sku_num", "split_original_amount",
        "split_activity_amount", "split_coupon_amount", F.col("split_total_amount").alias("split_payment_amount"), F.col("pay_ts_ms").alias("ts_ms"),
    )


@plan
def rt_dwd_pay_suc(rt_dwd_order_detail, cdc_changes, ods_base_dic):
    return paid_lines(rt_dwd_order_detail.withColumn("line_time", millis_to_ts("ts_ms")), paid(cdc_changes), ods_base_dic)


def refunds_asked(changes: DataFrame) -> DataFrame:
    return of_table(changes, "order_refund_info").filter(F.col("op").isin("c", "r")).select(
        *fields(["id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount", "refund_reason_type", "refund_reason_txt", "create_time"]),
        "ts_ms", millis_to_ts("ts_ms").alias("asked_at"),
    )


def order_places(changes: DataFrame, state: Column) -> DataFrame:
    """User and province of orders whose update satisfies ``state``."""
    return of_table(changes, "order_info").filter(state).select(
        F.col("after")["id"].alias("state_order_id"), F.col("after")["user_id"].alias("order_user_id"), *fields(["province_id"]), millis_to_ts("ts_ms").alias("state_at")
    )


def refunding() -> Column:
    return (F.col("op") == "u") & (F.col("after")["order_status"] == "1005")


def matched_refunds(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    return refunds.join(orders, F.col("order_id") == F.col("state_order_id"))


def named_refunds(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = with_label(rows, dictionary, "refund_type", "refund_type_name", parent="15", how="inner")
    named = with_label(named, dictionary, "refund_reason_type", "refund_reason_type_name", parent="13", how="inner")
    return named.select(
        "id", "user_id", "order_id", "sku_id", "province_id", F.substring("create_time", 1, 10).alias("date_id"), "create_time",
        F.col("refund_type").alias("refund_type_code"), "refund_type_name", F.col("refund_reason_type").alias("refund_reason_type_code"),
        "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount", "ts_ms",
    )


@plan
def rt_dwd_refund(cdc_changes, ods_base_dic):
    return named_refunds(matched_refunds(refunds_asked(cdc_changes), order_places(cdc_changes, refunding())), ods_base_dic)


def refund_payments(changes: DataFrame) -> DataFrame:
    return of_table(changes, "refund_payment").filter(became("refund_status", "1602")).select(
        *fields(["id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount"]), "ts_ms", millis_to_ts("ts_ms").alias("paid_at")
    )


def refunds_done(changes: DataFrame) -> DataFrame:
    return of_table(changes, "order_refund_info").filter(became("refund_status", "0705")).select(
        F.col("after")["order_id"].alias("done_order_id"), F.col("after")["sku_id"].alias("done_sku_id"), *fields(["refund_num"]), millis_to_ts("ts_ms").alias("done_at")
    )


def matched_refund_payments(payments: DataFrame, refunds: DataFrame, orders: DataFrame) -> DataFrame:
    same = (F.col("order_id") == F.col("done_order_id")) & (F.col("sku_id") == F.col("done_sku_id"))
    return payments.join(refunds, same).join(orders, F.col("order_id") == F.col("state_order_id"))


def named_refund_payments(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = with_label(rows, dictionary, "payment_type", "payment_type_name", parent="11", how="inner")
    return named.select(
        "id", F.col("order_user_id").alias("user_id"), "order_id", "sku_id", "province_id", F.col("payment_type").alias("payment_type_code"), "payment_type_name",
        F.substring("callback_time", 1, 10).alias("date_id"), "callback_time", "refund_num", F.col("total_amount").alias("refund_amount"), "ts_ms",
    )


@plan
def rt_dwd_refund_pay(cdc_changes, ods_base_dic):
    orders = order_places(cdc_changes, became("order_status", "1006"))
    return named_refund_payments(matched_refund_payments(refund_payments(cdc_changes), refunds_done(cdc_changes), orders), ods_base_dic)


# ---- summaries ---------------------------------------------------------------------------
def _date(ts="ts_ms"):
    return day_of(millis_to_ts(ts)).alias("date_id")


def _one(condition=None):
    return F.lit(1) if condition is None else condition.cast("int")


@plan
def rt_dws_interaction_user(rt_dwd_cart_add, rt_dwd_comment):
    carts = rt_dwd_cart_add.select("user_id", _date(), _one().alias("cart_add_count"), F.col("sku_num").alias("cart_add_num"))
    comments = rt_dwd_comment.select(
        "user_id", _date(), _one().alias("comment_count"), _one(F.col("appraise") == GOOD_COMMENT).alias("good_comment_count")
    )
    measures = {m: "bigint" for m in ("cart_add_count", "cart_add_num", "comment_count", "good_comment_count")}
    return stack_sums(["user_id", "date_id"], [carts, comments], measures).na.fill(0)


AMOUNTS = {
    "order_original_amount": "split_original_amount", "order_total_amount": "split_total_amount",
    "order_activity_amount": "split_activity_amount", "order_coupon_amount": "split_coupon_amount",
}


@plan
def rt_dws_province(rt_dwd_order_detail):
    per_order = rt_dwd_order_detail.groupBy("province_id", "date_id", "order_id").agg(
        F.sum(F.col("sku_num").cast("bigint")).alias("order_num"), *[F.sum(money(c, 16)).alias(n) for n, c in AMOUNTS.items()]
    )
    return per_order.groupBy("province_id", "date_id").agg(
        F.count("order_id").alias("order_count"), F.sum("order_num").alias("order_num"), *[F.sum(n).alias(n) for n in AMOUNTS]
    )


@plan
def rt_dws_user_goods(rt_dwd_order_detail, rt_dwd_cart_add, rt_dwd_comment):
    """Orders of a user for a product and day, with all carts and comments of the two."""
    per_order = rt_dwd_order_detail.groupBy("user_id", "sku_id", "date_id", "order_id").agg(
        F.sum(F.col("sku_num").cast("bigint")).alias("order_num"), *[F.sum(money(c, 16)).alias(n) for n, c in AMOUNTS.items()]
    )
    orders = per_order.groupBy("user_id", "sku_id", "date_id").agg(
        F.count("order_id").alias("order_count"), F.sum("order_num").alias("order_num"), *[F.sum(n).alias(n) for n in AMOUNTS]
    )
    keys = ["user_id", "sku_id"]
    carts = rt_dwd_cart_add.select(*keys, _one().alias("cart_add_count"), F.col("sku_num").alias("cart_add_num"))
    comments = rt_dwd_comment.select(*keys, _one().alias("comment_count"), _one(F.col("appraise") == GOOD_COMMENT).alias("good_comment_count"))
    measures = {m: "bigint" for m in ("cart_add_count", "cart_add_num", "comment_count", "good_comment_count")}
    return orders.join(stack_sums(keys, [carts, comments], measures), keys, "left")


def sync_rows(table: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a summary in one shape for every target: table, key, measure, value."""
    measures = [c for c in df.columns if c not in keys]
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("decimal(28,2)").alias("value")) for m in measures])
    return df.select(F.lit(table).alias("target_table"), F.concat_ws("|", *keys).alias("row_key"), F.inline(cells))


@plan
def rt_sync_mysql(rt_dws_interaction_user, rt_dws_province, rt_dws_user_goods):
    """What the three relational targets hold after a sync."""
    return (
        sync_rows("dws_interaction_user_stats", rt_dws_interaction_user, ["user_id", "date_id"])
        .unionByName(sync_rows("dws_trade_province_stats", rt_dws_province, ["province_id", "date_id"]))
        .unionByName(sync_rows("dws_user_goods_stats", rt_dws_user_goods, ["user_id", "sku_id", "date_id"]))
        .filter(F.col("value").isNotNull())
    )


@plan
def rf_cdc_to_lake(cdc_changes):
    """Current values of every key of every captured table, in the order of the log; deleted keys are gone."""
    rows = cdc_changes.select("table_name", F.coalesce(F.col("after")["id"], F.col("before")["id"]).alias("pk"), "op", "after", *log_position(), (F.col("op") == "d").alias("gone"))
    current = latest_per_key(rows.filter(F.col("pk").isNotNull()), ["table_name", "pk"], [*LOG_POSITION, "gone", "op"])
    return current.filter(~F.col("gone")).select("table_name", "pk", "op", "ts_ms", F.explode("after").alias("column", "value"))

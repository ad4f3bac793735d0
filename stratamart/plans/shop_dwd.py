"""Shop detail facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratamart.functions.columns import day_of, in_zone, millis_to_ts, or_zero
from stratamart.operators.lookups import with_label
from stratamart.operators.paths import first_of_each
from stratamart.warehouse import plan


def _lines_with_promotions(lines: DataFrame, activity: DataFrame, coupon: DataFrame) -> DataFrame:
    """Order lines with the activity and coupon they used, if any."""
    act = activity.select(F.col("order_detail_id").alias("id"), "activity_id", "activity_rule_id")
    cou = coupon.select(F.col("order_detail_id").alias("id"), "coupon_id")
    return lines.join(act, "id", "left").join(cou, "id", "left")


def _amounts():
    return [
        (F.col("sku_num") * F.col("order_price")).cast("decimal(18,2)").alias("split_original_amount"),
        or_zero("split_activity_amount").cast("decimal(18,2)").alias("split_activity_amount"),
        or_zero("split_coupon_amount").cast("decimal(18,2)").alias("split_coupon_amount"),
    ]


@plan
def dwd_order_lines(ods_order_detail, ods_order_info):
    """Order lines with the user and place of their order: all that the summaries need.

    Kept apart from the promotions so that a summary neither joins them nor
    counts a line twice when it used two.
    """
    order = ods_order_info.select(F.col("id").alias("order_id"), "user_id", "province_id")
    return ods_order_detail.join(order, "order_id", "left").select(
        "id", "order_id", "user_id", "sku_id", "province_id", day_of("create_time").alias("date_id"), "create_time", "sku_num",
        *_amounts(), F.col("split_total_amount").cast("decimal(18,2)").alias("split_total_amount"), day_of("create_time").alias("dt"),
    )


@plan
def dwd_order_detail(dwd_order_lines, ods_order_detail_activity, ods_order_detail_coupon):
    # the days follow from the time, so they need not travel
    lines = _lines_with_promotions(dwd_order_lines.drop("date_id", "dt"), ods_order_detail_activity, ods_order_detail_coupon)
    return lines.withColumns({"date_id": day_of("create_time"), "dt": day_of("create_time")}).select(
        *dwd_order_lines.columns, "activity_id", "activity_rule_id", "coupon_id"
    )


@plan
def dwd_paid_lines(ods_order_detail, ods_payment_info):
    """Order lines of paid orders."""
    pay = ods_payment_info.select("order_id", "user_id", "payment_type", "callback_time")
    return ods_order_detail.join(pay, "order_id").select(
        "id", "order_id", "user_id", "sku_id", "payment_type", "callback_time", "sku_num", *_amounts(),
        F.col("split_total_amount").cast("decimal(18,2)").alias("split_payment_amount"), day_of("callback_time").alias("dt"),
    )


@plan
def dwd_pay_suc_detail(dwd_paid_lines, ods_order_info, ods_order_detail_activity, ods_order_detail_coupon, ods_base_dic):
    order = ods_order_info.select(F.col("id").alias("order_id"), "province_id")
    placed = dwd_paid_lines.drop("dt").join(order, "order_id", "left")  # both sides are already partitioned by order
    # the day and the name follow from the time and the code, so they need not travel
    lines = _lines_with_promotions(placed, ods_order_detail_activity, ods_order_detail_coupon).withColumn("dt", day_of("callback_time"))
    return with_label(lines, ods_base_dic, "payment_type", "payment_type_name", parent="11").select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        F.col("payment_type").alias("payment_type_code"), "payment_type_name", F.col("dt").alias("date_id"), "callback_time", "sku_num",
        "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_payment_amount", "dt",
    )


@plan
def dwd_trade_flow_acc(ods_order_info, ods_payment_info, ods_order_status_log):
    """One row per order that gains its payment and finish times as they happen."""
    pay = ods_payment_info.select("order_id", F.col("callback_time").alias("payment_time"), F.col("total_amount").alias("payment_amount"))
    finish = ods_order_status_log.filter(F.col("order_status") == "1004").select("order_id", F.col("operate_time").alias("finish_time"))
    return (
        ods_order_info.withColumnRenamed("id", "order_id").join(pay, "order_id", "left").join(finish, "order_id", "left")
        .select(
            "order_id", "user_id", "province_id", day_of("create_time").alias("order_date_id"),
            F.col("create_time").alias("order_time"), day_of("payment_time").alias("payment_date_id"), "payment_time",
            day_of("finish_time").alias("finish_date_id"), "finish_time",
            F.col("original_total_amount").alias("order_original_amount"),
            F.col("activity_reduce_amount").alias("order_activity_amount"),
            F.col("coupon_reduce_amount").alias("order_coupon_amount"), F.col("total_amount").alias("order_total_amount"),
            or_zero("payment_amount").cast("decimal(16,2)").alias("payment_amount"),
        )
    )


@plan
def dwd_cart_add(ods_cart_info):
    return ods_cart_info.select(
        "id", "user_id", "sku_id", day_of("create_time").alias("date_id"), "create_time", "sku_num",
        day_of("create_time").alias("dt"),
    )


@plan
def dwd_cart_full(ods_cart_info):
    return ods_cart_info.filter(F.col("is_ordered") == "0").select("id", "user_id", "sku_id", "sku_name", "sku_num")


@plan
def dwd_coupon_used(ods_coupon_use):
    return ods_coupon_use.select(
        "id", "coupon_id", "user_id", "order_id", day_of("used_time").alias("date_id"), day_of("used_time").alias("dt")
    )


@plan
def dwd_favor_add(ods_favor_info):
    return ods_favor_info.select(
        "id", "user_id", "sku_id", day_of("create_time").alias("date_id"), "create_time", day_of("create_time").alias("dt")
    )


LOG_TYPE = (
    "common STRUCT<ar: STRING, ba: STRING, ch: STRING, is_new: STRING, md: STRING, mid: STRING, os: STRING, uid: STRING, "
    "vc: STRING, sid: STRING>, page STRUCT<item: STRING, item_type: STRING, last_page_id: STRING, page_id: STRING, "
    "from_pos_id: STRING, from_pos_seq: STRING, refer_id: STRING, during_time: BIGINT>, ts BIGINT"
)


def parsed_log(ods_log: DataFrame, zone: str) -> DataFrame:
    """Page events of the click log, every field read in one pass over the text."""
    doc = ods_log.select(F.from_json("log", LOG_TYPE).alias("j")).filter(F.col("j.page").isNotNull())
    local = in_zone(millis_to_ts("j.ts"), zone)
    return doc.select(
        F.col("j.common.ar").alias("province_id"), F.col("j.common.ba").alias("brand"), F.col("j.common.ch").alias("channel"),
        F.col("j.common.is_new").alias("is_new"), F.col("j.common.md").alias("model"), F.col("j.common.mid").alias("mid_id"),
        F.col("j.common.os").alias("operate_system"), F.col("j.common.uid").alias("user_id"),
        F.col("j.common.vc").alias("version_code"), F.col("j.page.item").alias("page_item"),
        F.col("j.page.item_type").alias("page_item_type"), "j.page.last_page_id", "j.page.page_id", "j.page.from_pos_id",
        "j.page.from_pos_seq", "j.page.refer_id", day_of(local).alias("date_id"), local.alias("view_time"),
        F.col("j.common.sid").alias("session_id"), "j.page.during_time", F.col("j.ts").alias("ts"),
    )


@plan
def dwd_page_view(ods_log, zone):
    return parsed_log(ods_log, zone).withColumn("dt", F.col("date_id"))


@plan
def dwd_user_login(ods_log, zone):
    """The first page event of each session that has a user."""
    keep = ["user_id", "date_id", F.col("view_time").alias("login_time"), "channel", "province_id", "version_code",
            "mid_id", "brand", "model", "operate_system"]
    events = parsed_log(ods_log, zone).filter(F.col("user_id").isNotNull())
    return first_of_each(events, ["session_id"], ["ts", "page_item", "page_id"], keep).withColumn("dt", F.col("date_id"))


@plan
def dwd_user_register(ods_user_info, ods_log, zone):
    """Users with the device and channel of their registration.

    A user may send the registration page more than once; the first one counts.
    """
    pages = parsed_log(ods_log, zone).filter((F.col("page_id") == "register") & F.col("user_id").isNotNull())
    keep = ["channel", "province_id", "version_code", "mid_id", "brand", "model", "operate_system"]
    first = first_of_each(pages, ["user_id"], ["ts", "page_item"], keep)
    users = ods_user_info.select(F.col("id").cast("string").alias("user_id"), "create_time")
    return users.join(first, "user_id", "left").select(
        "user_id", day_of("create_time").alias("date_id"), "create_time", *keep
    )

"""Product 360: one row per item and month."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratamart.functions.columns import month_of, rate, rate_or_null
from stratamart.warehouse import plan

GRAIN = ["item_id", "dt"]


@plan
def dwd03_product(ods03_product_info):
    return ods03_product_info.filter(F.col("item_id").isNotNull()).select(
        "item_id", "item_name", "category_id", "brand_id", "create_time", "is_deleted"
    )


@plan
def dwd03_sku(ods03_sku_info):
    return ods03_sku_info.filter(F.col("sku_id").isNotNull()).select("sku_id", "item_id", "spec", "stock", "sku_price", "create_time")


@plan
def dwd03_user(ods03_user_info):
    return ods03_user_info.filter(F.col("user_id").isNotNull()).select("user_id", "gender", "age", "region", "register_time")


@plan
def dwd03_order_detail(ods03_order_detail):
    return ods03_order_detail.filter(F.col("order_id").isNotNull()).select(
        "order_id", "user_id", "item_id", "sku_id", "order_price", "quantity", "order_status", month_of("order_time").alias("dt")
    )


@plan
def dwd03_payment(ods03_payment_info):
    return ods03_payment_info.filter(F.col("payment_id").isNotNull()).select(
        "payment_id", "order_id", "pay_amount", "pay_channel", month_of("pay_time").alias("dt")
    )


@plan
def dwd03_search_log(ods03_search_log):
    return ods03_search_log.filter(F.col("search_id").isNotNull()).select("search_id", "user_id", "keyword", month_of("search_time").alias("dt"))


@plan
def dwd03_content_log(ods03_content_log):
    return ods03_content_log.filter(F.col("content_id").isNotNull()).select(
        "content_id", "user_id", "item_id", "content_type", "interaction_type", month_of("interaction_time").alias("dt")
    )


@plan
def dwd03_comment(ods03_comment_info):
    return ods03_comment_info.filter(F.col("comment_id").isNotNull()).select(
        "comment_id", "user_id", "item_id", "sku_id", "score", "comment_text", month_of("comment_time").alias("dt")
    )


@plan
def dws03_item_order_month(dwd03_order_detail):
    """Buyers, orders and amount of an item: per order, then per user, then per item, so that no line is copied and a busy item spreads."""
    per_order = dwd03_order_detail.groupBy(*GRAIN, "user_id", "order_id").agg(
        F.sum(F.col("order_price").cast("decimal(16,2)") * F.col("quantity")).alias("amt")
    )
    # an order has one user, so the orders of an item's users add up
    per_user = per_order.groupBy(*GRAIN, "user_id").agg(F.count("order_id").alias("orders"), F.sum("amt").alias("amt"))
    return per_user.groupBy(*GRAIN).agg(F.count("user_id").alias("order_user_cnt"), F.sum("orders").alias("order_cnt"), F.sum("amt").alias("order_amt"))


@plan
def dws03_item_comment_month(dwd03_comment):
    return dwd03_comment.groupBy(*GRAIN).agg(
        F.count(F.lit(1)).alias("comment_cnt"), F.count_if(F.col("score") >= 4).alias("good_cnt"),
        F.count_if(F.col("score") <= 2).alias("bad_cnt"), rate_or_null(F.sum(F.col("score").cast("decimal(20,2)")), F.count("score"), 2).alias("avg_score"),
    )


@plan
def dws03_item_content_month(dwd03_content_log):
    """Interactions with an item's content, by kind."""
    kinds = {"view": "view_cnt", "cart": "cart_cnt", "collect": "collect_cnt", "click": "content_click_cnt"}
    return dwd03_content_log.groupBy(*GRAIN).agg(*[F.count_if(F.col("interaction_type") == k).alias(n) for k, n in kinds.items()])


@plan
def dws03_item_behavior_month(dws03_item_content_month, dws03_item_comment_month):
    """Interactions and comments of an item; each side is counted before they meet."""
    return dws03_item_content_month.join(dws03_item_comment_month, GRAIN, "left").na.fill(0, ["comment_cnt", "good_cnt", "bad_cnt"]).select(
        "item_id", "view_cnt", "cart_cnt", "collect_cnt", "comment_cnt", "good_cnt", "bad_cnt", "avg_score", "dt"
    )


@plan
def dws03_item_payment_month(dwd03_payment, dwd03_order_detail):
    """Payments of the orders that hold an item, in the month of both.

    An order may hold an item on several lines and be paid in several parts, so
    both sides are first brought to one row per order.
    """
    paid = dwd03_payment.groupBy("order_id", "dt").agg(F.count(F.lit(1)).alias("pays"), F.sum("pay_amount").alias("amount"))
    bought = dwd03_order_detail.select("order_id", "dt", "item_id", "user_id").distinct()
    per_user = bought.join(paid, ["order_id", "dt"]).groupBy(*GRAIN, "user_id").agg(
        F.sum("pays").alias("pays"), F.sum("amount").alias("amount")
    )
    return per_user.groupBy(*GRAIN).agg(
        F.count("user_id").alias("pay_user_cnt"), F.sum("pays").alias("pay_cnt"), F.sum("amount").alias("pay_amt")
    )


@plan
def dws03_item_conversion_month(dws03_item_behavior_month, dws03_item_payment_month, dws03_item_order_month):
    pay = dws03_item_payment_month.select(*GRAIN, "pay_user_cnt")
    order = dws03_item_order_month.select(*GRAIN, "order_user_cnt")
    return dws03_item_behavior_month.join(pay, GRAIN, "left").join(order, GRAIN, "left").select(
        "item_id", "view_cnt", "pay_user_cnt", "order_user_cnt", rate_or_null("pay_user_cnt", "view_cnt").alias("conversion_rate"),
        F.lit(0.0).alias("repurchase_rate"), "dt",
    )


@plan
def ads03_item_360(
    dws03_item_order_month, dws03_item_payment_month, dws03_item_content_month, dws03_item_comment_month, dwd03_sku
):
    content = dws03_item_content_month.withColumn("content_exp_cnt", F.col("view_cnt"))
    comment = dws03_item_comment_month.select(*GRAIN, "comment_cnt", "avg_score")
    sku = dwd03_sku.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("sku_cnt"),
        rate(F.sum(F.col("sku_price").cast("decimal(16,2)")), F.count("sku_price"), 2).alias("avg_price"),
    )
    out = dws03_item_order_month
    for side in (dws03_item_payment_month, content, comment):
        out = out.join(side, GRAIN, "left")
    out = out.join(sku, "item_id", "left")
    counts = ["pay_cnt", "pay_user_cnt", "view_cnt", "cart_cnt", "collect_cnt", "comment_cnt", "content_exp_cnt", "content_click_cnt", "sku_cnt"]
    out = out.withColumn("pay_amt", F.coalesce("pay_amt", F.lit(0).cast("decimal(16,2)"))).na.fill(0, counts).na.fill(0.0, ["avg_score", "avg_price"])
    return out.select(
        "item_id", "dt", "order_cnt", "order_user_cnt", "order_amt", "pay_cnt", "pay_user_cnt", "pay_amt", "view_cnt", "cart_cnt",
        "collect_cnt", rate("pay_user_cnt", "view_cnt").alias("conversion_rate"), F.lit(0.0).alias("repurchase_rate"), "comment_cnt",
        "avg_score", "content_exp_cnt", "content_click_cnt", "sku_cnt", "avg_price",
    )


@plan
def ads_new_old_users(fact_log):
    """Users per day who log in for the first time, and users who come back."""
    user_days = fact_log.select("user_id", "login_date").distinct()
    first = fact_log.groupBy("user_id").agg(F.min("login_date").alias("first_login_date"))
    is_first = F.col("login_date") == F.col("first_login_date")
    return user_days.join(first, "user_id").groupBy("login_date").agg(
        F.count_if(is_first).alias("new_user_count"), F.count_if(~is_first).alias("old_user_count")
    ).orderBy("login_date")

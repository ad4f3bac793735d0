"""Coupons sent by customer service: sends, uses and their effect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stratamart.functions.columns import days_before, labelled, money, rate, stable_id
from stratamart.operators.merge import beside
from stratamart.operators.zipper import scd_columns
from stratamart.warehouse import plan

# Wording of source codes and their labels.
LEVELS = {"商品级": "Product Level", "SKU级": "SKU Level"}
STATES = {"进行中": "Active", "已结束": "Ended", "已暂停": "Paused"}
KINDS = {"固定优惠": "Fixed Discount", "自定义优惠": "Custom Discount"}
UNKNOWN = "Unknown"
VALID = "有效"


@plan
def dim_customer_service(ods_cs_agent, as_of):
    return ods_cs_agent.filter(F.col("status").isNotNull()).select(
        "customer_service_id", "customer_service_name", "department", "position", "hire_date", "status", "create_time",
        "update_time", *scd_columns(as_of, ["customer_service_id"]),
    )


@plan
def dim_cs_activity(ods_cs_activity):
    days = F.datediff(F.col("activity_end_time").cast("date"), F.col("activity_start_time").cast("date"))
    return ods_cs_activity.select(
        stable_id("activity_id").alias("activity_sk"), "activity_id", "activity_name", "activity_level",
        labelled("activity_level", LEVELS, UNKNOWN).alias("activity_level_desc"), "activity_status",
        labelled("activity_status", STATES, UNKNOWN).alias("activity_status_desc"), "activity_start_time", "activity_end_time",
        days.alias("activity_duration"), "coupon_type", labelled("coupon_type", KINDS, UNKNOWN).alias("coupon_type_desc"), "creator_id",
        "create_time", "update_time", "max_valid_days", "max_products",
    )


@plan
def dim_cs_customer(ods_cs_customer):
    return ods_cs_customer.select("customer_id", "customer_name", "gender", "age", "level", "register_time", "last_login_time")


@plan
def dwd_coupon_send(ods_cs_send):
    return ods_cs_send.filter(F.col("send_id").isNotNull()).select(
        "send_id", "activity_id", "product_id", "sku_id", "customer_service_id", "customer_id", money("coupon_amount", 10).alias("coupon_amount"),
        "send_time", "expire_time", "usage_valid_hours", "send_channel", "remark", "send_status",
        F.col("send_time").cast("date").alias("send_date"), F.hour("send_time").alias("send_hour"), F.col("send_time").cast("date").alias("dt"),
    )


@plan
def dwd_coupon_usage(ods_cs_usage):
    return ods_cs_usage.filter(F.col("usage_id").isNotNull()).select(
        "usage_id", "send_id", "order_id", "activity_id", "product_id", "sku_id", "customer_service_id", "customer_id",
        money("coupon_amount", 10).alias("coupon_amount"), "usage_time", money("order_amount", 10).alias("order_amount"),
        money("actual_payment", 10).alias("actual_payment"), "order_status", "payment_time", F.col("usage_time").cast("date").alias("usage_date"),
        F.hour("usage_time").alias("usage_hour"), (money("order_amount", 10) - money("actual_payment", 10)).alias("save_amount"),
        F.col("usage_time").cast("date").alias("dt"),
    )


@plan
def dwd_activity_product(ods_cs_product):
    return ods_cs_product.filter(F.col("activity_id").isNotNull() & F.col("product_id").isNotNull()).select(
        "activity_id", "product_id", "sku_id", money("coupon_amount", 10).alias("coupon_amount"), "max_usage_count", "product_status",
        "add_time", "remove_time", money("min_price", 10).alias("min_price"), money("estimated_price", 10).alias("estimated_price"),
        ((F.col("product_status") == VALID) & F.col("remove_time").isNull()).alias("is_valid"),
    )




def _sends(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    per_customer = df.groupBy(*keys, "customer_id").agg(F.count(F.lit(1)).alias("n"), F.sum("coupon_amount").alias("amount"))
    return per_customer.groupBy(*keys).agg(
        F.sum("n").alias("send_count"), F.sum("amount").alias("total_coupon_amount"), F.count("customer_id").alias("customer_count")
    )


def _uses(df: DataFrame, keys: Sequence[str], distinct: str) -> DataFrame:
    """``distinct`` is counted once per key; the rest are plain sums."""
    per = df.groupBy(*keys, distinct).agg(
        F.count(F.lit(1)).alias("n"), F.sum("save_amount").alias("saved"), F.sum("order_amount").alias("amount")
    )
    return per.groupBy(*keys).agg(
        F.sum("n").alias("usage_count"), F.sum("saved").alias("total_save_amount"), F.count(distinct).alias("distinct_count"),
        F.sum("amount").alias("total_order_amount"),
    )


def _zeros(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


@plan
def dwd_cs_performance(dim_customer_service, dwd_coupon_send, dwd_coupon_usage):
    key = ["customer_service_id"]
    sends = _sends(dwd_coupon_send, key).select(*key, "send_count", "total_coupon_amount")
    uses = dwd_coupon_usage.groupBy(*key).agg(F.count(F.lit(1)).alias("usage_count"), F.sum("save_amount").alias("total_save_amount"))
    agents = dim_customer_service.filter("is_current").select(*key, "customer_service_name", "department", "position")
    joined = _zeros(agents.join(sends, key, "left").join(uses, key, "left"), "send_count", "usage_count", "total_coupon_amount", "total_save_amount")
    return joined.select(
        *key, "customer_service_name", "department", "position", "send_count", "usage_count", "total_coupon_amount", "total_save_amount",
        rate("usage_count", "send_count").alias("conversion_rate"), rate("total_coupon_amount", "send_count", 2).alias("avg_coupon_amount"),
    )


@plan
def dws_cs_performance(dwd_cs_performance, dwd_coupon_usage):
    key = ["customer_service_id"]
    orders = _uses(dwd_coupon_usage, key, "customer_id").select(
        *key, F.col("distinct_count").alias("customer_count"), F.col("usage_count").alias("order_count"), "total_order_amount"
    )
    joined = _zeros(dwd_cs_performance.join(orders, key, "left"), "customer_count", "order_count", "total_order_amount")
    return joined.withColumn("avg_order_amount", rate("total_order_amount", "order_count", 2))


@plan
def dws_activity_effect(dim_cs_activity, dwd_coupon_send, dwd_coupon_usage):
    key = ["activity_id"]
    uses = _uses(dwd_coupon_usage, key, "order_id").withColumnRenamed("distinct_count", "order_count")
    activities = dim_cs_activity.select(*key, "activity_name", "activity_level", "activity_status")
    joined = activities.join(_sends(dwd_coupon_send, key), key, "left").join(uses, key, "left")
    joined = _zeros(joined, "send_count", "total_coupon_amount", "customer_count", "usage_count", "total_save_amount", "order_count", "total_order_amount")
    return joined.select(
        *key, "activity_name", "activity_level", "activity_status", "send_count", "usage_count", "total_coupon_amount", "total_save_amount",
        rate("usage_count", "send_count").alias("conversion_rate"), "customer_count", "order_count", "total_order_amount",
        rate("total_order_amount", "usage_count", 2).alias("avg_order_amount"), rate("total_order_amount", "total_save_amount").alias("roi"),
    )


@plan
def dws_product_coupon(dwd_activity_product, dwd_coupon_send, dwd_coupon_usage):
    key = ["product_id", "sku_id"]
    uses = _uses(dwd_coupon_usage, key, "order_id").withColumnRenamed("distinct_count", "order_count")
    joined = dwd_activity_product.select(*key).join(_sends(dwd_coupon_send, key), key, "left").join(uses, key, "left")
    joined = _zeros(joined, "send_count", "total_coupon_amount", "customer_count", "usage_count", "total_save_amount", "order_count", "total_order_amount")
    full_price = F.col("total_order_amount") + F.col("total_save_amount")
    return joined.select(
        *key, "send_count", "usage_count", "total_coupon_amount", "total_save_amount", rate("usage_count", "send_count").alias("conversion_rate"),
        "customer_count", "order_count", "total_order_amount", rate("total_order_amount", "usage_count", 2).alias("avg_order_amount"),
        F.when(F.col("total_order_amount") > 0, rate("total_save_amount", full_price)).otherwise(F.lit(0.0)).alias("avg_discount_rate"),
    )


def _windows(send: DataFrame, use: DataFrame, as_of, keys: Sequence[str]) -> DataFrame:
    """7- and 30-day sends and uses per key in one shuffle: both facts are stacked, then summed by condition."""
    zero = F.lit(0).cast("decimal(10,2)")
    since = days_before(as_of, 30)

    def recent(df):
        return df.filter((F.col("dt") > since) & (F.col("dt") <= F.lit(as_of)))

    stacked = recent(send).select(*keys, "dt", F.lit(1).alias("s"), F.lit(0).alias("u"), "coupon_amount", zero.alias("save_amount")).unionByName(
        recent(use).select(*keys, "dt", F.lit(0).alias("s"), F.lit(1).alias("u"), zero.alias("coupon_amount"), "save_amount")
    )
    measures = {"send_count": "s", "usage_count": "u", "total_coupon_amount": "coupon_amount", "total_save_amount": "save_amount"}
    aggs = []
    for n in (7, 30):
        inside = F.col("dt") > days_before(as_of, n)
        aggs += [F.sum(F.when(inside, F.col(c)).otherwise(F.lit(0))).alias(f"{name}_{n}d") for name, c in measures.items()]
    return stacked.groupBy(*keys).agg(*aggs)


WINDOWED = [f"{m}_{n}d" for n in (7, 30) for m in ("send_count", "usage_count", "total_coupon_amount", "total_save_amount")]


@plan
def ads_activity_daily(dim_cs_activity, dwd_coupon_send, dwd_coupon_usage, as_of):
    spans = _windows(dwd_coupon_send, dwd_coupon_usage, as_of, ["activity_id"])
    joined = _zeros(dim_cs_activity.select("activity_id", "activity_name").join(spans, "activity_id", "left"), *WINDOWED)
    return joined.withColumn("stat_date", F.lit(as_of))


def _agents(dim: DataFrame, send: DataFrame, use: DataFrame, as_of) -> DataFrame:
    spans = _windows(send, use, as_of, ["customer_service_id"])
    agents = dim.filter("is_current").select("customer_service_id", "customer_service_name", "department", "position")
    return _zeros(agents.join(spans, "customer_service_id", "left"), *WINDOWED).withColumn("stat_date", F.lit(as_of))


@plan
def ads_cs_coupon_stats(dim_customer_service, dwd_coupon_send, dwd_coupon_usage, as_of):
    return _agents(dim_customer_service, dwd_coupon_send, dwd_coupon_usage, as_of).withColumns(
        {f"conversion_rate_{n}d": rate(f"usage_count_{n}d", f"send_count_{n}d") for n in (7, 30)}
    )


@plan
def ads_coupon_send_usage_detail(dwd_coupon_send, dwd_coupon_usage, as_of):
    use = dwd_coupon_usage.select("send_id", "usage_id", "order_id", "usage_time", "order_amount", "actual_payment", "save_amount", "order_status")
    return dwd_coupon_send.join(use, "send_id", "left").select(
        F.lit(as_of).alias("stat_date"), "send_id", "usage_id", "activity_id", "product_id", "sku_id", "customer_service_id", "customer_id",
        "coupon_amount", "send_time", "usage_time", "order_id", "order_amount", "actual_payment", "save_amount", "send_status", "order_status",
    )


@plan
def ads_time_period_summary(dwd_coupon_send, dwd_coupon_usage, as_of):
    """One row of totals: sends, uses and distinct orders of the last 7 and 30 days."""
    since = days_before(as_of, 30)
    used = dwd_coupon_usage.filter((F.col("dt") > since) & (F.col("dt") <= F.lit(as_of)))
    sent = dwd_coupon_send.filter((F.col("dt") > since) & (F.col("dt") <= F.lit(as_of)))
    orders = used.groupBy("order_id").agg(F.max("dt").alias("dt"), F.count(F.lit(1)).alias("uses"),
                                          F.count_if(F.col("dt") > days_before(as_of, 7)).alias("uses_7d"))
    use_totals = orders.agg(
        F.coalesce(F.sum("uses_7d"), F.lit(0)).alias("total_usage_count_7d"), F.count_if(F.col("uses_7d") > 0).alias("total_order_count_7d"),
        F.coalesce(F.sum("uses"), F.lit(0)).alias("total_usage_count_30d"), F.count(F.lit(1)).alias("total_order_count_30d"),
    )
    send_totals = sent.agg(
        F.count_if(F.col("dt") > days_before(as_of, 7)).alias("total_send_count_7d"), F.count(F.lit(1)).alias("total_send_count_30d")
    )


    return beside(send_totals, use_totals).withColumn("stat_date", F.lit(as_of))


@plan
def ads_cs_send_stats(dim_customer_service, dwd_coupon_send, dwd_coupon_usage, as_of):
    return _agents(dim_customer_service, dwd_coupon_send, dwd_coupon_usage, as_of).select(
        "stat_date", "customer_service_id", "customer_service_name", "department", "position", "send_count_7d", "send_count_30d"
    )


@plan
def ads_cs_usage_stats(dim_customer_service, dwd_coupon_send, dwd_coupon_usage, as_of):
    return _agents(dim_customer_service, dwd_coupon_send, dwd_coupon_usage, as_of).select(
        "stat_date", "customer_service_id", "customer_service_name", "department", "position", "usage_count_7d", "usage_count_30d"
    )

"""Product macro report: views, cart, orders and payments per product and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratamart.functions.columns import band, day_of, rate_or_null
from stratamart.operators.merge import stack_sums
from stratamart.operators.scans import changes
from stratamart.warehouse import plan

# Report bands.  "其他" is the label for a missing measure.
COUNT_BANDS = [(50, "0-50"), (100, "51-100"), (150, "101-150"), (300, "151-300")]
AMOUNT_BANDS = [(1000, "0-1000"), (5000, "1001-5000"), (10000, "5001-10000"), (50000, "10001-50000")]
MISSING_BAND = "其他"


@plan
def dwd01_page_log(ods01_page_log):
    return ods01_page_log.filter(F.col("page.page_id").isNotNull()).select(
        F.col("common.uid").alias("user_id"), F.col("page.item").alias("sku_id"), "page.page_id", "page.last_page_id",
        "page.during_time", "page.source_type", "ts", "dt",
    )


@plan
def dwd01_cart_add(ods01_cart_add):
    return changes(ods01_cart_add).select(
        "data.user_id", "data.sku_id", day_of("data.create_time").alias("date_id"), "data.create_time", "data.source_type",
        "data.source_id", "data.sku_num", "ts", "dt",
    )


@plan
def dwd01_order_detail(ods01_order_detail):
    return changes(ods01_order_detail).select(
        "data.user_id", "data.order_id", "data.sku_id", day_of("data.create_time").alias("date_id"), "data.create_time",
        "data.source_type", "data.source_id", "data.sku_num", "data.split_total_amount", "ts", "dt",
    )


@plan
def dwd01_pay_suc(ods01_payment_info, ods01_order_detail):
    """Payments with what was bought; a payment without its order line keeps its amount."""
    lines = changes(ods01_order_detail).select(
        F.col("data.order_id").alias("order_id"), F.col("data.sku_id").alias("line_sku"), F.col("data.sku_num").alias("line_num"), "dt"
    )
    pays = changes(ods01_payment_info).select("data.*", "ts", "dt")
    return pays.join(lines, ["order_id", "dt"], "left").select(
        "user_id", "order_id", F.coalesce("line_sku", F.lit("UNKNOWN")).alias("sku_id"), day_of("payment_time").alias("date_id"),
        "payment_time", F.coalesce("line_num", F.lit(0)).alias("sku_num"), F.col("total_amount").alias("split_payment_amount"),
        "ts", "dt",
    )


def _per_user(df: DataFrame, *sums) -> DataFrame:
    """Per product, day and user; makes the distinct count of users a plain count."""
    return df.groupBy("sku_id", "dt", "user_id").agg(F.count(F.lit(1)).alias("n"), *sums).groupBy("sku_id", "dt")


@plan
def dws01_product_view_1d(dwd01_page_log):
    views = dwd01_page_log.filter(F.col("page_id") == "good_detail")
    return _per_user(views, F.sum("during_time").alias("stay"), F.count("during_time").alias("stays")).agg(
        F.sum("n").alias("view_count_1d"), F.count("user_id").alias("view_user_count_1d"),
        F.floor(F.sum("stay") / F.sum("stays")).cast("bigint").alias("avg_stay_time_1d"),
    )


@plan
def dws01_product_cart_1d(dwd01_cart_add):
    return _per_user(dwd01_cart_add, F.sum("sku_num").alias("num")).agg(
        F.sum("n").alias("cart_add_count_1d"), F.count("user_id").alias("cart_add_user_count_1d"),
        F.sum("num").alias("cart_add_num_1d"),
    )


@plan
def dws01_product_order_1d(dwd01_order_detail):
    return _per_user(dwd01_order_detail, F.sum("sku_num").alias("num"), F.sum("split_total_amount").alias("amount")).agg(
        F.sum("n").alias("order_count_1d"), F.count("user_id").alias("order_user_count_1d"), F.sum("num").alias("order_num_1d"),
        F.sum("amount").alias("order_amount_1d"),
    )


@plan
def dws01_product_payment_1d(dwd01_pay_suc):
    return _per_user(dwd01_pay_suc, F.sum("sku_num").alias("num"), F.sum("split_payment_amount").alias("amount")).agg(
        F.sum("n").alias("payment_count_1d"), F.count("user_id").alias("payment_user_count_1d"),
        F.sum("num").alias("payment_num_1d"), F.sum("amount").alias("payment_amount_1d"),
    )


@plan
def ads01_product_efficiency(dws01_product_view_1d, dws01_product_cart_1d, dws01_product_order_1d, dws01_product_payment_1d):
    """One row per day over all products: conversion from view to cart, order and payment."""
    measures = {
        "view_user_count_1d": "bigint", "view_count_1d": "bigint", "avg_stay_time_1d": "bigint", "cart_add_num_1d": "bigint",
        "cart_add_user_count_1d": "bigint", "order_user_count_1d": "bigint", "order_num_1d": "bigint",
        "order_amount_1d": "decimal(24,2)", "payment_user_count_1d": "bigint", "payment_num_1d": "bigint",
        "payment_amount_1d": "decimal(24,2)",
    }
    facts = [dws01_product_view_1d, dws01_product_cart_1d, dws01_product_order_1d, dws01_product_payment_1d]
    products = stack_sums(["sku_id", "dt"], facts, measures)
    visitors = F.sum("view_user_count_1d")
    day = F.col("dt")
    return products.groupBy("dt").agg(
        visitors.alias("product_visitor_count"),
        F.sum("view_count_1d").alias("product_view_count"),
        F.count_if(F.col("view_count_1d") > 0).alias("visited_product_count"),
        rate_or_null(F.sum("avg_stay_time_1d"), F.count("avg_stay_time_1d") * 1000, 2).alias("avg_stay_time"),
        F.sum("cart_add_num_1d").alias("cart_add_num"),
        F.sum("cart_add_user_count_1d").alias("cart_add_user_count"),
        rate_or_null(F.sum("cart_add_user_count_1d"), visitors).alias("cart_conversion_rate"),
        F.sum("order_user_count_1d").alias("order_user_count"),
        F.sum("order_num_1d").alias("order_num"),
        F.sum("order_amount_1d").alias("order_amount"),
        rate_or_null(F.sum("order_user_count_1d"), visitors).alias("order_conversion_rate"),
        F.sum("payment_user_count_1d").alias("payment_user_count"),
        F.sum("payment_num_1d").alias("payment_num"),
        F.sum("payment_amount_1d").alias("payment_amount"),
        F.count_if(F.col("payment_amount_1d") > 0).alias("paid_product_count"),
        rate_or_null(F.sum("payment_user_count_1d"), visitors).alias("payment_conversion_rate"),
        rate_or_null(F.sum("payment_amount_1d"), F.sum("payment_user_count_1d"), 2).alias("customer_price"),
    ).withColumns({
        "stat_week": F.concat_ws("-", F.extract(F.lit("YEAROFWEEK"), day), F.lpad(F.weekofyear(day).cast("string"), 2, "0")),
        "stat_month": F.date_format(day, "yyyy-MM"),
        "stat_year": F.year(day),
    })


@plan
def ads01_range_analysis(dws01_product_payment_1d, ods01_sku_info, log_as_of):
    """Products, amount and pieces per price band, pieces band and amount band of the day."""
    paid = dws01_product_payment_1d.filter(F.col("dt") == F.lit(log_as_of)).select("sku_id", "payment_num_1d", "payment_amount_1d")
    priced = ods01_sku_info.select(F.col("id").alias("sku_id"), "price").join(paid, "sku_id", "left").select(
        F.lit("price_range").alias("range_type"), band("price", COUNT_BANDS, "300+", MISSING_BAND).alias("range_value"),
        F.coalesce("payment_amount_1d", F.lit(0)).cast("decimal(24,2)").alias("amount"), F.coalesce("payment_num_1d", F.lit(0)).alias("num"),
    )
    kinds = F.array(
        F.struct(F.lit("payment_num_range").alias("range_type"), band("payment_num_1d", COUNT_BANDS, "300+", MISSING_BAND).alias("range_value")),
        F.struct(F.lit("payment_amount_range").alias("range_type"), band("payment_amount_1d", AMOUNT_BANDS, "50000+", MISSING_BAND).alias("range_value")),
    )
    banded = paid.select(
        F.inline(kinds), F.col("payment_amount_1d").cast("decimal(24,2)").alias("amount"), F.col("payment_num_1d").alias("num")
    )
    # a product is one row of each input, so rows are products
    return priced.unionByName(banded).groupBy("range_type", "range_value").agg(
        F.count(F.lit(1)).alias("active_product_count"), F.sum("amount").alias("payment_amount"), F.sum("num").alias("payment_num"),
        rate_or_null(F.sum("amount"), F.sum("num"), 2).alias("avg_price"),
    ).withColumn("stat_date", F.lit(log_as_of))

"""Shop reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window, functions as F

from stratamart.functions.columns import days_before, rate, rate_or_null, seconds_between
from stratamart.operators.cohorts import active_days, has_run, retention
from stratamart.operators.merge import beside
from stratamart.operators.paths import numbered_steps
from stratamart.operators.ranking import top_ranked
from stratamart.operators.windows import day_and_spans, recent_days
from stratamart.plans.shop_dws import PLACE_COLUMNS
from stratamart.warehouse import plan

CATEGORY = ["category1_id", "category1_name", "category2_id", "category2_name", "category3_id", "category3_name"]


@plan
def ads_coupon_stats(dws_coupon_used_1d):
    return dws_coupon_used_1d.groupBy("dt", "coupon_id", "coupon_name").agg(
        F.sum("used_count_1d").alias("used_count"), F.count(F.lit(1)).alias("used_user_count")
    )


@plan
def ads_new_order_user(dws_user_order_td, as_of):
    return (
        recent_days(dws_user_order_td, as_of, day="order_date_first").groupBy("recent_days")
        .agg(F.count(F.lit(1)).alias("new_order_user_count")).withColumn("dt", F.lit(as_of))
    )


@plan
def ads_order_by_province(dws_province_order_1d, as_of):
    measures = {"order_count": "order_count_1d", "order_total_amount": "order_total_amount_1d"}
    rows = day_and_spans(dws_province_order_1d, as_of, measures, [7, 30])
    return rows.groupBy("recent_days", "province_id", *PLACE_COLUMNS).agg(*[F.sum(m).alias(m) for m in measures]).withColumn("dt", F.lit(as_of))


def _last_week(orders, as_of):
    return orders.filter((F.col("dt") >= days_before(as_of, 6)) & (F.col("dt") <= F.lit(as_of))).select("user_id", "dt")


def _one_number(df, as_of, count):
    return df.agg(count.alias("order_continuously_user_count")).select(
        F.lit(as_of).alias("dt"), F.lit(7).alias("recent_days"), "order_continuously_user_count"
    )


def _gap_to_second_next(orders, as_of):
    # a user has at most one row per day of the week, so the window stays small
    by_day = Window.partitionBy("user_id").orderBy("dt")
    later = F.lead("dt", 2, dt.date(9999, 12, 31)).over(by_day)
    return _last_week(orders, as_of).withColumn("gap", F.datediff(later, "dt"))


@plan
def ads_continuous_order(dws_user_order_1d, as_of):
    """Users with orders on three consecutive days of the last seven: by looking two rows ahead."""
    runs = _gap_to_second_next(dws_user_order_1d, as_of).filter(F.col("gap") == 2)
    return _one_number(runs, as_of, F.countDistinct("user_id"))


@plan
def ads_continuous_order_islands(dws_user_order_1d, as_of):
    """The same by islands: day less rank is constant within a run."""
    by_day = Window.partitionBy("user_id").orderBy("dt")
    runs = (
        _last_week(dws_user_order_1d, as_of).withColumn("island", F.date_sub("dt", F.rank().over(by_day)))
        .groupBy("user_id", "island").count().filter(F.col("count") >= 3)
    )
    return _one_number(runs, as_of, F.countDistinct("user_id"))


@plan
def ads_continuous_order_bitmap(dws_user_order_1d, as_of):
    """The same by one bit per day."""
    users = active_days(dws_user_order_1d, "user_id", as_of).filter(has_run(F.col("days"), 3))
    return _one_number(users, as_of, F.count(F.lit(1)))


@plan
def ads_continuous_order_gap(dws_user_order_1d, as_of):
    """Users with three order days within four days."""
    runs = _gap_to_second_next(dws_user_order_1d, as_of).filter(F.col("gap") <= 3)
    return _one_number(runs, as_of, F.countDistinct("user_id"))


def _orders_and_buyers(one_day, keys, as_of):
    rows = day_and_spans(one_day, as_of, {"order_count": "order_count_1d"}, [7, 30]).select("recent_days", "user_id", *keys, "order_count")
    # per user first: the distinct count needs it, and a popular key is spread over its users
    per_user = rows.groupBy("recent_days", *keys, "user_id").agg(F.sum("order_count").alias("order_count"))
    return per_user.groupBy("recent_days", *keys).agg(
        F.sum("order_count").alias("order_count"), F.count_if(F.col("order_count") > 0).alias("order_user_count")
    ).withColumn("dt", F.lit(as_of))


@plan
def ads_order_by_cate(dws_user_sku_order_1d, as_of):
    return _orders_and_buyers(dws_user_sku_order_1d, CATEGORY, as_of)


@plan
def ads_order_by_brand(dws_user_sku_order_1d, as_of):
    return _orders_and_buyers(dws_user_sku_order_1d, ["tm_id", "tm_name"], as_of)


@plan
def ads_order_to_pay_avg(dwd_trade_flow_acc, as_of):
    """Mean seconds from order to payment, over the payments of the day."""
    paid = dwd_trade_flow_acc.filter(F.col("payment_date_id") == F.lit(as_of))
    return paid.agg(
        F.floor(F.avg(seconds_between("order_time", "payment_time"))).cast("bigint").alias("order_to_pay_interval_avg")
    ).withColumn("dt", F.lit(as_of))


@plan
def ads_page_path(dwd_page_view):
    """How often each step of a session leads to each next step, per day."""
    steps = numbered_steps(
        dwd_page_view, ["session_id", "dt"], ["ts", "page_item"], "page_id", slice_of=F.date_trunc("minute", "view_time")
    )
    source = F.concat(F.lit("step-"), "step", F.lit(":"), "page_id")
    target = F.concat(F.lit("step-"), F.col("step") + 1, F.lit(":"), "next_page")
    return steps.groupBy("dt", source.alias("source"), F.coalesce(target, F.lit("null")).alias("target")).agg(
        F.count(F.lit(1)).alias("path_count")
    )


@plan
def ads_repeat_purchase(dws_user_sku_order_nd, as_of):
    per_user = dws_user_sku_order_nd.groupBy("tm_id", "tm_name", "user_id").agg(F.sum("order_count_30d").alias("order_count"))
    return per_user.groupBy("tm_id", "tm_name").agg(
        rate_or_null(F.count_if(F.col("order_count") >= 2), F.count_if(F.col("order_count") >= 1)).alias("order_repeat_rate")
    ).select(F.lit(as_of).alias("dt"), F.lit(30).alias("recent_days"), "tm_id", "tm_name", "order_repeat_rate")


@plan
def ads_cart_top3_by_cate(dwd_cart_full, dim_sku_names, log_as_of):
    pieces = dwd_cart_full.groupBy("sku_id").agg(F.sum("sku_num").alias("cart_num"))
    sku = dim_sku_names.select(F.col("id").alias("sku_id"), "sku_name", *CATEGORY)
    ranked = top_ranked(pieces.join(sku, "sku_id", "left"), ["category1_id", "category2_id", "category3_id"], "cart_num", 3)
    return ranked.select(F.lit(log_as_of).alias("dt"), *CATEGORY, "sku_id", "sku_name", "cart_num", "rk")


@plan
def ads_favor_top3_by_brand(dws_sku_favor_1d):
    ranked = top_ranked(dws_sku_favor_1d, ["dt", "tm_id"], "favor_add_count_1d", 3)
    return ranked.select("dt", "tm_id", "tm_name", "sku_id", "sku_name", "favor_add_count_1d", "rk")


@plan
def ads_traffic_by_channel(dws_session_page_view_1d, log_as_of):
    """Visitors, stay, pages, sessions and bounces per channel and window."""
    copies = recent_days(dws_session_page_view_1d, log_as_of)
    # per visitor first, so that the distinct count needs no second copy of the sessions
    per_visitor = copies.groupBy("recent_days", "channel", "mid_id").agg(
        F.sum("during_time_1d").alias("during"), F.sum("page_count_1d").alias("pages"),
        F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("page_count_1d") == 1).alias("bounced"),
    )
    sessions = F.sum("sessions")
    return per_visitor.groupBy("recent_days", "channel").agg(
        F.count("mid_id").alias("uv_count"),
        F.floor(F.sum("during") / sessions / 1000).cast("bigint").alias("avg_duration_sec"),
        F.floor(F.sum("pages") / sessions).cast("bigint").alias("avg_page_count"),
        sessions.alias("sv_count"),
        rate(F.sum("bounced"), sessions).alias("bounce_rate"),
    ).withColumn("dt", F.lit(log_as_of))


@plan
def ads_user_action(dws_page_visitor_1d, dws_user_cart_1d, dws_user_order_1d, dws_user_payment_1d, as_of, log_as_of):
    """Home, detail, cart, order and payment visitors of the day, in one row."""
    pages = dws_page_visitor_1d.filter((F.col("dt") == F.lit(log_as_of)) & F.col("page_id").isin("home", "good_detail")).agg(
        F.count_if(F.col("page_id") == "home").alias("home_count"),
        F.count_if(F.col("page_id") == "good_detail").alias("good_detail_count"),
    )

    def users(df, day, name):
        return df.filter(F.col("dt") == F.lit(day)).agg(F.count(F.lit(1)).alias(name))

    return beside(
        pages,
        users(dws_user_cart_1d, log_as_of, "cart_count"),
        users(dws_user_order_1d, as_of, "order_count"),
        users(dws_user_payment_1d, as_of, "payment_count"),
    ).withColumn("dt", F.lit(log_as_of))


@plan
def ads_user_change(dws_user_login_td, dws_user_login_td_previous, log_as_of):
    """Users last seen exactly a week ago, and users back after eight days or more."""
    churned = dws_user_login_td.filter(F.col("login_date_last") == days_before(log_as_of, 7)).agg(
        F.count(F.lit(1)).alias("user_churn_count")
    )
    today = dws_user_login_td.filter(F.col("login_date_last") == F.lit(log_as_of)).select("user_id")
    before = dws_user_login_td_previous.filter(F.col("login_date_last") <= days_before(log_as_of, 8)).select("user_id")
    back = today.join(before, "user_id").agg(F.count(F.lit(1)).alias("user_back_count"))
    return beside(churned, back).withColumn("dt", F.lit(log_as_of))


@plan
def ads_user_retention(dws_user_login_td, log_as_of):
    return retention(dws_user_login_td, log_as_of, "login_date_first", "login_date_last")


@plan
def ads_user_stats(dws_user_login_td, log_as_of):
    new = F.datediff(F.lit(log_as_of), "login_date_first") < F.col("recent_days")
    return recent_days(dws_user_login_td, log_as_of, day="login_date_last").groupBy("recent_days").agg(
        F.count_if(new).alias("new_user_count"), F.count(F.lit(1)).alias("active_user_count")
    ).withColumn("dt", F.lit(log_as_of))

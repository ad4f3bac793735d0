"""Page traffic: pages, modules, sessions and paths per day.

Every table keeps its day ``dt`` in the grain, so one run fills all partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratamart.functions.columns import by_prefix, hash_bucket, rate
from stratamart.operators.merge import stack_sums
from stratamart.operators.paths import numbered_steps
from stratamart.warehouse import plan

# How page and module ids decode, in order of precedence.
PAGE_NAMES = [("home%", "首页"), ("product%", "商品详情页"), ("cart%", "购物车页"), ("payment%", "支付页"), ("category%", "分类页")]
PAGE_TYPES = [("home%", "首页"), ("product%", "商品页"), ("cart%", "购物车页"), ("payment%", "支付页"), ("category%", "分类页")]
PAGE_LEVELS = [("home%", 1), ("category%", 2), ("product%", 3), ("cart%", 4), ("payment%", 5)]
SOURCE_PAGES = ("home%", "product%", "cart%", "category%")
OTHER_PAGE, OTHER_PAGE_TYPE, OTHER_LEVEL = "其他页面", "其他页", 6
MODULE_NAMES = [("banner%", "轮播图"), ("recommend%", "推荐商品"), ("category%", "分类导航"), ("search%", "搜索框"), ("cart%", "购物车")]
MODULE_TYPES = [("banner%", "展示类"), ("recommend%", "商品类"), ("category%", "导航类"), ("search%", "功能类"), ("cart%", "功能类")]
OTHER_MODULE, OTHER_MODULE_TYPE = "其他模块", "其他类"
POSITIONS = [("%top", "顶部"), ("%middle", "中部"), ("%bottom", "底部")]
NO_POSITION = "未知"
USER_LEVELS = ["VIP", "高级", "普通"]
GENDERS = ["男", "女"]
AGE_GROUPS = ["18-25", "26-35", "36-45", "46+"]


def _one_of(key: str, salt: str, values: list[str]):
    """An attribute that is arbitrary but the same on every run."""
    bucket = hash_bucket(F.concat(F.lit(salt), F.col(key).cast("string")), len(values)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), bucket + 1)


@plan
def dim10_user(ods10_click, ods10_page_view, ods10_order):
    seen = [df.select("user_id", "dt", "create_time") for df in (ods10_click, ods10_page_view, ods10_order)]
    users = seen[0].unionByName(seen[1]).unionByName(seen[2]).groupBy("user_id", "dt").agg(F.max("create_time").alias("create_time"))
    return users.select(
        "user_id", F.lit("2025-01-01").alias("register_date"), _one_of("user_id", "level", USER_LEVELS).alias("user_level"),
        _one_of("user_id", "gender", GENDERS).alias("gender"), _one_of("user_id", "age", AGE_GROUPS).alias("age_group"),
        "create_time", "dt",
    )


@plan
def dim10_page(ods10_click, ods10_page_view, ods10_order):
    seen = [
        ods10_click.select("page_id", "dt", "create_time"), ods10_page_view.select("page_id", "dt", "create_time"),
        ods10_order.select(F.col("source_page_id").alias("page_id"), "dt", "create_time"),
    ]
    pages = seen[0].unionByName(seen[1]).unionByName(seen[2]).groupBy("page_id", "dt").agg(F.max("create_time").alias("create_time"))
    return pages.select(
        "page_id", by_prefix("page_id", PAGE_NAMES, OTHER_PAGE).alias("page_name"),
        by_prefix("page_id", PAGE_TYPES, OTHER_PAGE_TYPE).alias("page_type"),
        by_prefix("page_id", PAGE_LEVELS, OTHER_LEVEL).alias("page_level"), "create_time", "dt",
    )


@plan
def dim10_module(ods10_click):
    modules = ods10_click.filter(F.col("module_id").isNotNull()).groupBy("module_id", "dt").agg(F.max("create_time").alias("create_time"))
    return modules.select(
        "module_id", by_prefix("module_id", MODULE_NAMES, OTHER_MODULE).alias("module_name"),
        by_prefix("module_id", MODULE_TYPES, OTHER_MODULE_TYPE).alias("module_type"),
        by_prefix("module_id", POSITIONS, NO_POSITION).alias("position"), "create_time", "dt",
    )


@plan
def dim10_session(ods10_click, ods10_page_view):
    """Sessions from views and clicks; entry and exit are the first and last page by time."""
    views = ods10_page_view.select(
        "log_id", "session_id", "user_id", "page_id", "view_time", "stay_time", F.lit(0).alias("bounced"), "create_time", "dt"
    )
    clicks = ods10_click.select(
        "log_id", "session_id", "user_id", "page_id", F.col("click_time").alias("view_time"), F.lit(5).alias("stay_time"),
        F.col("is_bounce").alias("bounced"), "create_time", "dt",
    )
    # one row per session and page first: a distinct count of pages beside other aggregates,
    # and a long session is spread over its pages
    moment = F.struct("view_time", "log_id")
    per_page = views.unionByName(clicks).groupBy("session_id", "user_id", "dt", "page_id").agg(
        F.min(moment).alias("first"), F.max(moment).alias("last"), F.sum("stay_time").alias("stay"),
        F.max("bounced").alias("bounced"), F.max("create_time").alias("created"),
    )
    return per_page.groupBy("session_id", "user_id", "dt").agg(
        F.min("first.view_time").alias("start_time"), F.max("last.view_time").alias("end_time"),
        F.sum("stay").alias("session_duration"), F.min_by("page_id", "first").alias("entry_page_id"),
        F.max_by("page_id", "last").alias("exit_page_id"), F.count("page_id").alias("page_count"),
        F.max("bounced").alias("is_bounced"), F.max("created").alias("create_time"),
    )


@plan
def dim10_order_source_page(ods10_order, ods10_page_view):
    """Pages that led to orders, with the share of their visitors who ordered."""
    names = [p for p in PAGE_NAMES if p[0] in SOURCE_PAGES]
    types = [p for p in PAGE_TYPES if p[0] in SOURCE_PAGES]
    buyers = ods10_order.groupBy("source_page_id", "dt", "user_id").agg(F.max("create_time").alias("create_time"))
    orders = buyers.groupBy("source_page_id", "dt").agg(F.count("user_id").alias("buyers"), F.max("create_time").alias("create_time"))
    visitors = ods10_page_view.groupBy(F.col("page_id").alias("source_page_id"), "dt").agg(F.countDistinct("user_id").alias("visitors"))
    return orders.join(visitors, ["source_page_id", "dt"], "left").select(
        "source_page_id", by_prefix("source_page_id", names, OTHER_PAGE).alias("source_page_name"),
        by_prefix("source_page_id", types, OTHER_PAGE_TYPE).alias("source_page_type"),
        rate("buyers", "visitors").alias("conversion_rate"), "create_time", "dt",
    )


@plan
def dim10_date(ods10_page_view):
    day = F.col("dt")
    return ods10_page_view.select("dt").distinct().select(
        F.date_format(day, "yyyyMMdd").alias("date_key"), F.date_format(day, "yyyy-MM-dd").alias("date_value"),
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"), (F.weekday(day) + 1).alias("day_of_week"),
        (F.weekday(day) >= 5).cast("int").alias("is_weekend"),
    )


@plan
def dwd10_click(ods10_click):
    return ods10_click.select(
        "log_id", "user_id", "session_id", "page_id", "module_id", "click_time", "is_bounce", F.hour("click_time").alias("hour_id"),
        "create_time", "dt",
    )


@plan
def dwd10_page_view(ods10_page_view):
    return ods10_page_view.select(
        "log_id", "user_id", "session_id", "page_id", "view_time", "stay_time", F.hour("view_time").alias("hour_id"), "create_time", "dt"
    )


@plan
def dwd10_order(ods10_order):
    return ods10_order.select(
        "order_id", "user_id", "order_time", "payment_amount", "source_page_id", F.hour("order_time").alias("hour_id"), "create_time", "dt"
    )


@plan
def dwd10_session(dim10_session, ods10_click):
    clicks = ods10_click.groupBy("session_id", "dt").agg(F.count(F.lit(1)).alias("click_count"))
    return dim10_session.join(clicks, ["session_id", "dt"], "left").select(
        "session_id", "user_id", "start_time", "end_time", "session_duration", "entry_page_id", "exit_page_id", "page_count",
        F.coalesce("click_count", F.lit(0)).alias("click_count"), "is_bounced", "create_time", "dt",
    )


@plan
def dwd10_user_behavior(ods10_click, ods10_page_view, ods10_order, dim10_session):
    """All a user did in a day.  The facts meet by union, so no list of users is built first."""
    one = F.lit(1).cast("bigint")
    views = ods10_page_view.select("user_id", "dt", "create_time", one.alias("pv_count"), F.col("stay_time").alias("total_stay_time"))
    clicks = ods10_click.select("user_id", "dt", "create_time", one.alias("click_count"))
    orders = ods10_order.select("user_id", "dt", "create_time", one.alias("order_count"), F.col("payment_amount").alias("order_amount"))
    sessions = dim10_session.select("user_id", "dt", one.alias("session_count"), (F.col("is_bounced") == 1).cast("bigint").alias("bounce_count"))
    parts = [views, clicks, orders, sessions]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    counts = ["pv_count", "click_count", "session_count", "total_stay_time", "bounce_count", "order_count", "order_amount"]
    return stacked.groupBy("user_id", "dt").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts], F.max("create_time").alias("create_time")
    )


@plan
def dws10_page_1d(dim10_page, dwd10_page_view, dwd10_click, dwd10_session, dwd10_order):
    viewers = dwd10_page_view.groupBy("page_id", "dt", "user_id").agg(F.count(F.lit(1)).alias("n"))
    views = viewers.groupBy("page_id", "dt").agg(F.sum("n").alias("pv_count"), F.count("user_id").alias("visitor_count"))
    clicks = dwd10_click.groupBy("page_id", "dt").agg(F.count(F.lit(1)).alias("click_count"))
    entries = dwd10_session.groupBy(F.col("entry_page_id").alias("page_id"), "dt").agg(F.count(F.lit(1)).alias("session_count"))
    bounces = dwd10_session.filter(F.col("is_bounced") == 1).groupBy(F.col("exit_page_id").alias("page_id"), "dt").agg(
        F.count(F.lit(1)).alias("bounce_count")
    )
    buyers = dwd10_order.groupBy(F.col("source_page_id").alias("page_id"), "dt", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("payment_amount").alias("amount")
    )
    orders = buyers.groupBy("page_id", "dt").agg(
        F.sum("n").alias("order_count"), F.sum("amount").alias("order_amount"), F.count("user_id").alias("order_user_count")
    )
    measures = {
        "pv_count": "bigint", "click_count": "bigint", "visitor_count": "bigint", "session_count": "bigint", "bounce_count": "bigint",
        "order_count": "bigint", "order_amount": "decimal(24,2)", "order_user_count": "bigint",
    }
    pages = stack_sums(["page_id", "dt"], [views, clicks, entries, bounces, orders], measures)
    named = dim10_page.select("page_id", "page_name", "dt").join(pages, ["page_id", "dt"], "left")
    return named.select("page_id", "page_name", *[F.coalesce(m, F.lit(0)).alias(m) for m in measures], "dt")


@plan
def dws10_user_1d(dwd10_user_behavior):
    return dwd10_user_behavior.select(
        "user_id", "pv_count", "click_count", "session_count", "total_stay_time", "bounce_count", "order_count", "order_amount", "dt"
    )


@plan
def dws10_module_1d(dwd10_click, dim10_module):
    per_user = dwd10_click.filter(F.col("module_id").isNotNull()).groupBy("module_id", "page_id", "dt", "user_id").agg(F.count(F.lit(1)).alias("n"))
    modules = per_user.groupBy("module_id", "page_id", "dt").agg(F.sum("n").alias("click_count"), F.count("user_id").alias("click_user_count"))
    return modules.join(dim10_module.select("module_id", "module_name", "dt"), ["module_id", "dt"]).select(
        "module_id", "module_name", "page_id", "click_count", "click_user_count", "dt"
    )


@plan
def dws10_session_1d(dwd10_session):
    return dwd10_session.select("session_id", "user_id", "session_duration", "page_count", "click_count", "is_bounced", "dt")


@plan
def dws10_page_path_1d(dwd10_page_view):
    steps = numbered_steps(
        dwd10_page_view, ["session_id", "dt"], ["view_time", "log_id"], "page_id", slice_of=F.date_trunc("minute", "view_time")
    )
    return steps.filter(F.col("next_page").isNotNull()).groupBy(
        F.col("page_id").alias("source_page_id"), F.col("next_page").alias("target_page_id"), "dt"
    ).agg(F.count(F.lit(1)).alias("path_count"))


@plan
def ads10_page_module(dws10_module_1d, dim10_page, dim10_module, dwd10_click, dwd10_order):
    """Clicks of a module and the orders of those who clicked it; an order counts once per module."""
    clickers = dwd10_click.select("page_id", "module_id", "user_id", "dt").distinct()
    buyers = dwd10_order.groupBy("user_id", "dt").agg(F.count(F.lit(1)).alias("n"), F.sum("payment_amount").alias("amount"))
    orders = clickers.join(buyers, ["user_id", "dt"]).groupBy("page_id", "module_id", "dt").agg(
        F.sum("n").alias("order_count"), F.count("user_id").alias("order_user_count"), F.sum("amount").alias("order_amount")
    )
    return (
        dws10_module_1d.join(dim10_page.select("page_id", "page_name", "dt"), ["page_id", "dt"])
        .join(dim10_module.select("module_id", "module_type", "dt"), ["module_id", "dt"])
        .join(orders, ["page_id", "module_id", "dt"], "left")
        .select(
            "page_id", "page_name", "module_id", "module_name", "module_type", "click_count", "click_user_count",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("order_count", "order_user_count", "order_amount")],
            rate("order_user_count", "click_user_count").alias("click_conversion_rate"), "dt",
        )
    )


@plan
def ads10_page_trend(dws10_page_1d, dwd10_click):
    clickers = dwd10_click.groupBy("page_id", "dt").agg(F.countDistinct("user_id").alias("click_user_count"))
    return dws10_page_1d.join(clickers, ["page_id", "dt"], "left").select(
        "page_id", "page_name", "pv_count", "visitor_count", "click_count", F.coalesce("click_user_count", F.lit(0)).alias("click_user_count"),
        "bounce_count", rate("bounce_count", "session_count").alias("bounce_rate"), "order_count", "order_user_count", "order_amount",
        rate("order_user_count", "visitor_count").alias("visitor_conversion_rate"), "dt",
    )


@plan
def ads10_hourly_visit(dwd10_page_view, dwd10_click, dwd10_order):
    visitors = dwd10_page_view.groupBy("hour_id", "dt", "user_id").agg(F.count(F.lit(1)).alias("n"))
    views = visitors.groupBy("hour_id", "dt").agg(F.sum("n").alias("pv_count"), F.count("user_id").alias("visitor_count"))
    clicks = dwd10_click.groupBy("hour_id", "dt").agg(F.count(F.lit(1)).alias("click_count"))
    orders = dwd10_order.groupBy("hour_id", "dt").agg(F.count(F.lit(1)).alias("order_count"), F.sum("payment_amount").alias("order_amount"))
    return views.join(clicks, ["hour_id", "dt"], "left").join(orders, ["hour_id", "dt"], "left").select(
        "hour_id", "pv_count", "visitor_count", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("click_count", "order_count", "order_amount")],
        rate(F.coalesce("order_count", F.lit(0)), "visitor_count").alias("conversion_rate"), "dt",
    )


@plan
def ads10_campaign_effect(dws10_page_1d):
    return dws10_page_1d.select(
        "page_id", "page_name", "pv_count", "visitor_count", "click_count", "order_count", "order_user_count", "order_amount",
        rate("order_user_count", "visitor_count").alias("visitor_conversion_rate"),
        rate("order_count", "click_count").alias("click_conversion_rate"), "dt",
    )


def _most_frequent(df: DataFrame, label: str, name: str) -> DataFrame:
    """The label a user meets most often in a day; ties go to the first by name."""
    counted = df.groupBy("user_id", "dt", label).agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.col(label), F.struct((-F.col("n")).alias("n"), F.col(label)))
    return counted.groupBy("user_id", "dt").agg(best.alias(name))


@plan
def ads10_user_preference(dws10_user_1d, dwd10_page_view, dwd10_click):
    pages = _most_frequent(
        dwd10_page_view.withColumn("page_type", by_prefix("page_id", PAGE_TYPES, OTHER_PAGE_TYPE)), "page_type", "preferred_page_type"
    )
    modules = _most_frequent(
        dwd10_click.filter(F.col("module_id").isNotNull()).withColumn("module_type", by_prefix("module_id", MODULE_TYPES, OTHER_MODULE_TYPE)),
        "module_type", "preferred_module_type",
    )
    return dws10_user_1d.join(pages, ["user_id", "dt"], "left").join(modules, ["user_id", "dt"], "left").select(
        "user_id", "preferred_page_type", "preferred_module_type", F.col("pv_count").alias("total_pv_count"),
        F.col("click_count").alias("total_click_count"), F.col("order_amount").alias("total_order_amount"), "dt",
    )

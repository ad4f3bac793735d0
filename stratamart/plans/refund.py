"""Refund topic: orders, refunds, logistics and behaviour, profiles and warnings.

Wide tables keep the grain of their main fact.  The other side of a
many-to-many relation is first reduced to one row per key, so nothing is
multiplied and the summaries count every fact once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratamart.functions.columns import labelled, rate, rate_or_null
from stratamart.operators.merge import beside, join_salted
from stratamart.operators.paths import latest_of_each
from stratamart.warehouse import plan

# Tiers, thresholds and labels.
STATUS_LABELS = {"completed": "已完成", "cancelled": "已取消", "refunded": "已退款", "pending": "待处理", "shipped": "已发货"}
OTHER_STATUS = "其他"
HIGH_VALUE, MEDIUM_VALUE = 10000, 5000
RISK_RATE = 50
REASONS = ("退款率过高", "退款次数过多", "退款金额过大", "正常")
METRIC_NAMES = {
    "total_orders": "总订单数", "total_refunds": "总退款数", "total_order_amount": "订单总金额", "total_refund_amount": "退款总金额",
    "avg_order_amount": "平均订单金额", "overall_refund_rate": "整体退款率",
}
KNOWN_TYPES = ("user", "order", "product")


@plan
def rf_log_route(ods_rf_log):
    """Each log line to the route of its type; what cannot be read or has no known type is dirty.

    Every readable line also goes to ``all``.
    """
    kind = F.try_parse_json("value")
    typed = ods_rf_log.withColumn("doc", kind).withColumn("type", F.get_json_object("value", "$.type"))
    route = F.when(F.col("doc").isNotNull() & F.col("type").isin(*KNOWN_TYPES), F.col("type")).otherwise(F.lit("dirty"))
    routes = F.when(F.col("doc").isNotNull(), F.array(route, F.lit("all"))).otherwise(F.array(route))
    return typed.select(F.explode(routes).alias("route"), "value")


BEHAVIOR_TYPES = ("view", "click", "purchase", "signup")


@plan
def rf_ods_tables(ods_rf_order, ods_rf_refund, ods_rf_logistics, ods_rf_behavior):
    """Rows per source table and day of its sync time, with rejected rows counted as error data."""

    def loaded(df, name):
        return df.groupBy(F.col("sync_time").cast("date").alias("dt")).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "dt", "row_count"
        )

    good = F.col("behavior_type").isin(*BEHAVIOR_TYPES)
    parts = [
        loaded(ods_rf_order, "ods_order"), loaded(ods_rf_refund, "ods_refund"), loaded(ods_rf_logistics, "ods_logistics"),
        loaded(ods_rf_behavior.filter(good), "ods_user_behavior"), loaded(ods_rf_behavior.filter(~good), "ods_error_data"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@plan
def rf_ods_error_data(ods_rf_behavior):
    """Rejected rows of the behaviour source: what is wrong, where, and the row as it came."""
    reason = F.when(F.col("user_id").isNull(), F.lit("missing user")).when(~F.col("behavior_type").isin(*BEHAVIOR_TYPES), F.lit("unknown behaviour type"))
    field = F.when(F.col("user_id").isNull(), F.lit("user_id")).otherwise(F.lit("behavior_type"))
    raw = F.concat_ws("|", *[F.col(c).cast("string") for c in ("behavior_id", "user_id", "behavior_type", "page_url")])
    return ods_rf_behavior.withColumn("error_reason", reason).filter("error_reason is not null").select(
        F.md5(F.concat_ws("|", F.lit("ods_user_behavior"), raw)).alias("error_id"), F.lit("ods_user_behavior").alias("table_name"), field.alias("error_field"),
        "error_reason", raw.alias("raw_data"), F.col("sync_time").alias("create_time"), F.col("sync_time").cast("date").alias("dt"),
    )


def _refunds_per_order(refund: DataFrame) -> DataFrame:
    latest = F.max_by("refund_status", F.struct("refund_apply_time", "refund_id"))
    return refund.groupBy("order_id").agg(
        F.sum("refund_amount").alias("refund_amount"), latest.alias("refund_status"), F.count(F.lit(1)).alias("refund_count")
    )


@plan
def rf_dwd_order_wide(ods_rf_order, ods_rf_refund, ods_rf_logistics, ods_rf_behavior):
    """Orders by logistics node, with the order's refunds and the user's latest behaviour."""
    behavior = latest_of_each(
        ods_rf_behavior, ["user_id"], ["behavior_time", "behavior_id"], ["behavior_type", "behavior_time", "page_url"]
    )
    per_order = join_salted(ods_rf_order.join(_refunds_per_order(ods_rf_refund), "order_id", "left"), behavior, ["user_id"], ["order_id"])
    nodes = ods_rf_logistics.select("order_id", "logistics_node", "node_time", "express_company")
    return per_order.join(nodes, "order_id", "left").select(
        "order_id", "user_id", "sku_id", "order_amount", "pay_time", "commit_ship_time", "order_status", "create_time", "data_source",
        "refund_amount", "refund_status", "refund_count", "logistics_node", "node_time", "express_company", "behavior_type",
        "behavior_time", "page_url",
    )


@plan
def rf_dwd_refund_wide(ods_rf_refund, ods_rf_order, ods_rf_logistics):
    """Refunds with their order and its latest logistics node."""
    order = ods_rf_order.select("order_id", "order_amount", "order_status", "pay_time")
    node = latest_of_each(
        ods_rf_logistics, ["order_id"], ["node_time", "logistics_id"], ["logistics_node", "node_time", "express_company"]
    )
    return ods_rf_refund.join(order, "order_id", "left").join(node, "order_id", "left").select(
        "refund_id", "order_id", "user_id", "refund_amount", "refund_status", "refund_apply_time", "user_input_reason",
        "refund_finish_time", "data_source", "order_amount", "order_status", "pay_time", "logistics_node", "node_time", "express_company",
    )


@plan
def rf_dwd_behavior_wide(ods_rf_behavior, ods_rf_order):
    """Behaviour with the user's orders: how many, their total and the latest one."""
    last = F.max_by(F.struct("order_id", "order_status"), F.struct("create_time", "order_id"))
    orders = ods_rf_order.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("order_amount").alias("order_amount"), last.alias("last")
    )
    return join_salted(ods_rf_behavior, orders, ["user_id"], ["behavior_id"]).select(
        "behavior_id", "user_id", "behavior_type", "behavior_time", "page_url", "data_source", "order_count", "order_amount",
        F.col("last.order_id").alias("last_order_id"), F.col("last.order_status").alias("last_order_status"),
    )


@plan
def rf_dws_order_by_user(ods_rf_order, ods_rf_refund):
    refunded = ods_rf_refund.groupBy("order_id").agg(F.sum("refund_amount").alias("refund_amount"))
    return ods_rf_order.join(refunded, "order_id", "left").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("order_amount").alias("total_order_amount"),
        rate(F.sum("order_amount"), F.count(F.lit(1)), 2).alias("avg_order_amount"), F.max("order_amount").alias("max_order_amount"),
        F.min("order_amount").alias("min_order_amount"), F.min("create_time").alias("first_order_time"),
        F.max("create_time").alias("last_order_time"), F.bool_or(F.coalesce(F.col("refund_amount") > 0, F.lit(False))).alias("has_refund_order"),
        F.max("data_source").alias("data_source"),
    )


@plan
def rf_dws_refund_by_user(ods_rf_refund, ods_rf_order):
    """Refunds per user; ``refund_rate`` is refunds per hundred orders of the user,
    ``refund_share`` refunds per hundred refunding users."""
    refunds = ods_rf_refund.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("refund_count"), F.sum("refund_amount").alias("total_refund_amount"),
        F.min("refund_apply_time").alias("first_refund_time"), F.max("refund_apply_time").alias("last_refund_time"),
        F.max("data_source").alias("data_source"),
    )
    orders = ods_rf_order.groupBy("user_id").agg(F.count(F.lit(1)).alias("orders"))
    refunders = refunds.agg(F.count(F.lit(1))).scalar()
    joined = refunds.join(orders, "user_id", "left").withColumn("refunders", refunders)
    return joined.select(
        "user_id", "refund_count", "total_refund_amount", rate("total_refund_amount", "refund_count", 2).alias("avg_refund_amount"),
        rate(F.col("refund_count") * 100, "orders", 2).alias("refund_rate"), rate(F.col("refund_count") * 100, "refunders", 4).alias("refund_share"),
        "first_refund_time", "last_refund_time", "data_source",
    )


@plan
def rf_dws_logistics(ods_rf_logistics, ods_rf_order):
    order = ods_rf_order.select("order_id", "create_time")
    nodes = ods_rf_logistics.filter(F.col("express_company").isNotNull() & F.col("node_time").isNotNull()).join(order, "order_id")
    on_time = F.count_if(F.col("node_time") <= F.col("create_time") + F.expr("INTERVAL 3 DAYS"))
    return nodes.filter(F.col("create_time").isNotNull()).groupBy("express_company").agg(
        F.count(F.lit(1)).alias("delivery_count"), on_time.alias("on_time_delivery_count"), F.max("data_source").alias("data_source")
    ).withColumn("on_time_delivery_rate", rate(F.col("on_time_delivery_count") * 100, "delivery_count", 2))


@plan
def rf_dws_behavior(ods_rf_behavior):
    per_type = ods_rf_behavior.groupBy("user_id", "behavior_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("behavior_time").alias("first"), F.max("behavior_time").alias("last"),
        F.max("data_source").alias("data_source"),
    )
    return per_type.groupBy("user_id").agg(
        F.sum("n").alias("behavior_count"), F.count("behavior_type").alias("distinct_behavior_types"), F.min("first").alias("first_behavior_time"),
        F.max("last").alias("last_behavior_time"), F.max("data_source").alias("data_source"),
    )


@plan
def rf_dws_status_refund(ods_rf_order, ods_rf_refund):
    joined = ods_rf_order.join(_refunds_per_order(ods_rf_refund), "order_id", "left")
    return joined.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("order_count"), F.count("refund_count").alias("refund_order_count"),
        rate(F.count("refund_count") * 100, F.count(F.lit(1)), 2).alias("refund_rate"),
        rate(F.sum("refund_amount"), F.sum("refund_count"), 2).alias("avg_refund_amount"), F.max("data_source").alias("data_source"),
    )


@plan
def rf_ads_user_profile(rf_dws_order_by_user, rf_dws_refund_by_user):
    refund = rf_dws_refund_by_user.select("user_id", "refund_count", "total_refund_amount", "refund_rate", "first_refund_time", "last_refund_time")
    spent = F.col("total_order_amount")
    tier = F.when(spent >= HIGH_VALUE, "high").when(spent >= MEDIUM_VALUE, "medium").otherwise("low")
    return rf_dws_order_by_user.join(refund, "user_id", "left").select(
        "user_id", "order_count", F.coalesce("refund_count", F.lit(0)).alias("refund_count"), "total_order_amount",
        F.coalesce("total_refund_amount", F.lit(0)).alias("total_refund_amount"), "avg_order_amount",
        F.coalesce("refund_rate", F.lit(0.0)).alias("refund_rate"), "first_order_time", "last_order_time", "first_refund_time",
        "last_refund_time", (F.coalesce("refund_rate", F.lit(0.0)) > RISK_RATE).alias("is_risk_user"), tier.alias("user_value_level"), "data_source",
    )


@plan
def rf_ads_carrier_eval(rf_dws_logistics):
    r = F.col("on_time_delivery_rate")
    level = F.when(r >= 95, "excellent").when(r >= 90, "good").when(r >= 80, "fair").otherwise("poor")
    return rf_dws_logistics.select(
        "express_company", "delivery_count", "on_time_delivery_count", "on_time_delivery_rate", level.alias("service_level"), "data_source"
    )


@plan
def rf_ads_status_analysis(rf_dws_status_refund):
    return rf_dws_status_refund.withColumn("status_description", labelled("order_status", STATUS_LABELS, OTHER_STATUS))


@plan
def rf_ads_overall_metrics(rf_dws_order_by_user, rf_dws_refund_by_user):
    """Six totals as named rows, from one pass over each summary."""
    orders = rf_dws_order_by_user.agg(
        F.sum("order_count").alias("orders"), F.sum("total_order_amount").alias("amount"), rate_or_null(F.sum(F.col("avg_order_amount").cast("decimal(20,2)")), F.count("avg_order_amount"), 2).alias("mean"),
        F.max("data_source").alias("data_source"),
    )
    refunds = rf_dws_refund_by_user.agg(F.sum("refund_count").alias("refunds"), F.sum("total_refund_amount").alias("refunded"))
    values = {
        "total_orders": F.col("orders"), "total_refunds": F.col("refunds"), "total_order_amount": F.col("amount"),
        "total_refund_amount": F.col("refunded"), "avg_order_amount": F.col("mean"), "overall_refund_rate": rate(F.col("refunds") * 100, "orders", 2),
    }
    rows = [
        F.struct(F.lit(name).alias("metric_name"), v.cast("double").alias("metric_value"), F.lit(METRIC_NAMES[name]).alias("metric_desc"))
        for name, v in values.items()
    ]
    return beside(orders, refunds).select(F.inline(F.array(*rows)), "data_source")


@plan
def rf_ads_behavior_trend(ods_rf_behavior):
    """Behaviour per day: events, users, types."""
    day = F.col("behavior_time").cast("date").alias("stat_date")
    # one read: per user and type, then per user with the types seen, then per day; the types of a day are the few that occur at all
    cell = ods_rf_behavior.groupBy(day, "user_id", "behavior_type").agg(F.count(F.lit(1)).alias("n"))
    user = cell.groupBy("stat_date", "user_id").agg(F.sum("n").alias("n"), F.collect_set("behavior_type").alias("types"))
    daily = user.groupBy("stat_date").agg(
        F.sum("n").alias("behavior_count"), F.count("user_id").alias("distinct_user_count"), F.flatten(F.collect_set("types")).alias("types")
    )
    return daily.withColumn("distinct_behavior_types", F.size(F.array_distinct("types")).cast("bigint")).drop("types").withColumn(
        "avg_behavior_per_user", rate("behavior_count", "distinct_user_count", 2)
    )


@plan
def rf_ads_high_value(rf_dws_order_by_user, as_of):
    return rf_dws_order_by_user.filter(F.col("total_order_amount") >= MEDIUM_VALUE).select(
        "user_id", "total_order_amount", "order_count", "avg_order_amount", "last_order_time",
        F.datediff(F.lit(as_of), F.col("last_order_time")).alias("days_since_last_order"), "data_source",
    )


@plan
def rf_ads_risk_warning(rf_dws_refund_by_user):
    r, n, amount = F.col("refund_rate"), F.col("refund_count"), F.col("total_refund_amount")
    level = F.when((r >= 50) | (n >= 10), "high").when((r >= 20) | (n >= 5), "medium").otherwise("low")
    reason = F.when(r >= 50, REASONS[0]).when(n >= 10, REASONS[1]).when(amount >= 5000, REASONS[2]).otherwise(REASONS[3])
    return rf_dws_refund_by_user.filter((r >= 20) | (n >= 5) | (amount >= 5000)).select(
        "user_id", "refund_count", "refund_rate", "total_refund_amount", level.alias("risk_level"), reason.alias("warning_reason"), "data_source"
    )

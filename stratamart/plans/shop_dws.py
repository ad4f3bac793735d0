"""Shop summaries: one day, n days, to date."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratamart.operators.windows import rolled_sums
from stratamart.warehouse import plan

SKU_COLUMNS = [
    "sku_name", "category1_id", "category1_name", "category2_id", "category2_name", "category3_id", "category3_name",
    "tm_id", "tm_name",
]
PLACE_COLUMNS = ["province_name", "area_code", "iso_code", "iso_3166_2"]
AMOUNTS = {
    "order_original_amount": "split_original_amount",
    "activity_reduce_amount": "split_activity_amount",
    "coupon_reduce_amount": "split_coupon_amount",
    "order_total_amount": "split_total_amount",
}


def _amounts(suffix: str):
    return [F.sum(source).cast("decimal(24,2)").alias(f"{stem}_{suffix}") for stem, source in AMOUNTS.items()]


def _per_order_then(df, grain):
    """Distinct orders and amounts in one pass: amounts per order first, then orders per grain.

    Counting distinct orders next to sums would copy every line; this shuffles
    one partial row per order instead, and a busy grain is spread over its orders.
    """
    per_order = df.groupBy(*grain, "order_id").agg(
        F.sum("sku_num").alias("sku_num"), *[F.sum(c).alias(c) for c in AMOUNTS.values()]
    )
    return per_order.groupBy(*grain)


@plan
def dws_province_order_1d(dwd_order_lines, dim_province):
    daily = _per_order_then(dwd_order_lines, ["province_id", "dt"]).agg(
        F.count("order_id").alias("order_count_1d"), *_amounts("1d")
    )
    place = dim_province.select(F.col("id").alias("province_id"), *PLACE_COLUMNS)
    return daily.join(place, "province_id", "left").select(
        "province_id", *PLACE_COLUMNS, "order_count_1d", *[f"{a}_1d" for a in AMOUNTS], "dt"
    )


@plan
def dws_province_order_nd(dws_province_order_1d, as_of):
    stems = {m: f"{m}_1d" for m in ["order_count", *AMOUNTS]}
    return rolled_sums(dws_province_order_1d, ["province_id", *PLACE_COLUMNS], stems, as_of)


@plan
def dws_sku_favor_1d(dwd_favor_add, dim_sku_names):
    daily = dwd_favor_add.groupBy("sku_id", "dt").agg(F.count(F.lit(1)).alias("favor_add_count_1d"))
    sku = dim_sku_names.select(F.col("id").alias("sku_id"), *SKU_COLUMNS)
    return daily.join(sku, "sku_id", "left").select("sku_id", *SKU_COLUMNS, "favor_add_count_1d", "dt")


@plan
def dws_coupon_used_1d(dwd_coupon_used, dim_coupon):
    daily = dwd_coupon_used.groupBy("user_id", "coupon_id", "dt").agg(F.count(F.lit(1)).alias("used_count_1d"))
    coupon = dim_coupon.select(
        F.col("id").alias("coupon_id"), "coupon_name", "coupon_type_code", "coupon_type_name", "benefit_rule"
    )
    return daily.join(coupon, "coupon_id", "left").select(
        "user_id", "coupon_id", "coupon_name", "coupon_type_code", "coupon_type_name", "benefit_rule", "used_count_1d", "dt"
    )


@plan
def dws_user_cart_1d(dwd_cart_add):
    return dwd_cart_add.groupBy("user_id", "dt").agg(
        F.count(F.lit(1)).alias("cart_add_count_1d"), F.sum("sku_num").alias("cart_add_num_1d")
    )


@plan
def dws_user_order_1d(dwd_order_lines):
    return _per_order_then(dwd_order_lines, ["user_id", "dt"]).agg(
        F.count("order_id").alias("order_count_1d"), F.sum("sku_num").alias("order_num_1d"), *_amounts("1d")
    )


@plan
def dws_user_order_td(dws_user_order_1d, as_of):
    return dws_user_order_1d.filter(F.col("dt") <= F.lit(as_of)).groupBy("user_id").agg(
        F.min("dt").alias("order_date_first"), F.max("dt").alias("order_date_last"),
        F.sum("order_count_1d").alias("order_count_td"), F.sum("order_num_1d").alias("order_num_td"),
        F.sum("order_original_amount_1d").alias("original_amount_td"),
        F.sum("activity_reduce_amount_1d").alias("activity_reduce_amount_td"),
        F.sum("coupon_reduce_amount_1d").alias("coupon_reduce_amount_td"),
        F.sum("order_total_amount_1d").alias("total_amount_td"),
    )


@plan
def dws_user_payment_1d(dwd_paid_lines):
    per_order = dwd_paid_lines.groupBy("user_id", "dt", "order_id").agg(
        F.sum("sku_num").alias("sku_num"), F.sum("split_payment_amount").alias("amount")
    )
    return per_order.groupBy("user_id", "dt").agg(
        F.count("order_id").alias("payment_count_1d"), F.sum("sku_num").alias("payment_num_1d"),
        F.sum("amount").alias("payment_amount_1d"),
    )


@plan
def dws_user_sku_order_1d(dwd_order_lines, dim_sku_names):
    daily = dwd_order_lines.groupBy("user_id", "sku_id", "dt").agg(
        F.count(F.lit(1)).alias("order_count_1d"), F.sum("sku_num").alias("order_num_1d"), *_amounts("1d")
    )
    sku = dim_sku_names.select(F.col("id").alias("sku_id"), *SKU_COLUMNS)
    return daily.join(sku, "sku_id", "left").select(
        "user_id", "sku_id", *SKU_COLUMNS, "order_count_1d", "order_num_1d", *[f"{a}_1d" for a in AMOUNTS], "dt"
    )


@plan
def dws_user_sku_order_nd(dws_user_sku_order_1d, as_of):
    stems = {m: f"{m}_1d" for m in ["order_count", "order_num", *AMOUNTS]}
    return rolled_sums(dws_user_sku_order_1d, ["user_id", "sku_id", *SKU_COLUMNS], stems, as_of)


@plan
def dws_page_visitor_1d(dwd_page_view):
    return dwd_page_view.groupBy("mid_id", "brand", "model", "operate_system", "page_id", "dt").agg(
        F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("view_count_1d")
    )


@plan
def dws_session_page_view_1d(dwd_page_view):
    return dwd_page_view.groupBy(
        "session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel", "dt"
    ).agg(F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("page_count_1d"))


def _login_to_date(users, logins, before=None):
    if before is not None:
        logins = logins.filter(F.col("dt") <= F.lit(before))
        users = users.filter(F.col("create_time").cast("date") <= F.lit(before))
    seen = logins.groupBy("user_id").agg(F.max("dt").alias("login_date_last"), F.count(F.lit(1)).alias("login_count_td"))
    registered = F.col("create_time").cast("date")
    return users.select(F.col("id").cast("string").alias("user_id"), "create_time").join(seen, "user_id", "left").select(
        "user_id",
        F.coalesce("login_date_last", registered).alias("login_date_last"),
        registered.alias("login_date_first"),
        F.coalesce("login_count_td", F.lit(1)).alias("login_count_td"),
    )


@plan
def dws_user_login_td(dim_user_zip, dwd_user_login, log_as_of):
    """Login history up to the run date; a user who never logged in counts by registration."""
    return _login_to_date(dim_user_zip, dwd_user_login, log_as_of)


@plan
def dws_user_login_td_previous(dim_user_zip, dwd_user_login, log_as_of):
    """The same table as it stood one day earlier."""
    import datetime as dt

    return _login_to_date(dim_user_zip, dwd_user_login, log_as_of - dt.timedelta(days=1))

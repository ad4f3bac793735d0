"""Shop dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from stratamart.functions.columns import mask_email, mask_mobile, mask_name
from stratamart.operators.lookups import with_label
from stratamart.operators.zipper import opened
from stratamart.warehouse import plan


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _benefit(kind: str, rules: dict[str, Column]) -> Column:
    out = F.lit(None).cast("string")
    for code, text in rules.items():
        out = F.when(F.col(kind) == code, text).otherwise(out)
    return out


# Wording of the benefit texts.
def _amount_off() -> Column:
    return F.concat(F.lit("满"), _text("condition_amount"), F.lit("元减"), _text("benefit_amount"), F.lit("元"))


def _pieces_discount() -> Column:
    return F.concat(F.lit("满"), _text("condition_num"), F.lit("件打"), _text("benefit_discount"), F.lit(" 折"))


def _discount() -> Column:
    return F.concat(F.lit("打"), _text("benefit_discount"), F.lit("折"))


def _reduce() -> Column:
    return F.concat(F.lit("减"), _text("benefit_amount"), F.lit("元"))


@plan
def dim_activity(ods_activity_rule, ods_activity_info, ods_base_dic):
    info = ods_activity_info.select(
        F.col("id").alias("activity_id"), "activity_name", "activity_desc", "start_time", "end_time", "create_time"
    )
    named = with_label(ods_activity_rule, ods_base_dic, "activity_type", "activity_type_name", parent="31")
    return named.join(info, "activity_id", "left").select(
        F.col("id").alias("activity_rule_id"), "activity_id", "activity_name",
        F.col("activity_type").alias("activity_type_code"), "activity_type_name", "activity_desc", "start_time",
        "end_time", "create_time", "condition_amount", "condition_num", "benefit_amount", "benefit_discount",
        _benefit("activity_type", {"3101": _amount_off(), "3102": _pieces_discount(), "3103": _discount()}).alias("benefit_rule"),
        "benefit_level",
    )


@plan
def dim_coupon(ods_coupon_info, ods_base_dic):
    named = with_label(ods_coupon_info, ods_base_dic, "coupon_type", "coupon_type_name", parent="32")
    named = with_label(named, ods_base_dic, "range_type", "range_type_name", parent="33")
    return named.select(
        "id", "coupon_name", F.col("coupon_type").alias("coupon_type_code"), "coupon_type_name", "condition_amount",
        "condition_num", "activity_id", "benefit_amount", "benefit_discount",
        _benefit("coupon_type", {"3201": _amount_off(), "3202": _pieces_discount(), "3203": _reduce()}).alias("benefit_rule"),
        "create_time", F.col("range_type").alias("range_type_code"), "range_type_name", "limit_num", "taken_count",
        "start_time", "end_time", "operate_time", "expire_time",
    )


@plan
def dim_date(ods_order_detail):
    """A calendar over the days the facts cover."""
    span = ods_order_detail.agg(
        F.min("create_time").cast("date").alias("first"), F.max("create_time").cast("date").alias("last")
    )
    day = F.col("date_id")
    return span.select(F.explode(F.sequence("first", "last")).alias("date_id")).select(
        day.alias("date_id"),
        F.weekofyear(day).alias("week_id"),
        (F.weekday(day) + 1).alias("week_day"),
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        (F.weekday(day) < 5).alias("is_workday"),
    )


@plan
def dim_promotion_pos(ods_promotion_pos):
    return ods_promotion_pos.select("id", "pos_type", "promotion_type", "create_time", "operate_time")


@plan
def dim_promotion_refer(ods_promotion_refer):
    return ods_promotion_refer.select("id", "refer_name", "create_time", "operate_time")


@plan
def dim_province(ods_base_province, ods_base_region):
    region = ods_base_region.select(F.col("id").alias("region_id"), "region_name")
    return ods_base_province.join(region, "region_id", "left").select(
        "id", F.col("name").alias("province_name"), "area_code", "iso_code", "iso_3166_2", "region_id", "region_name"
    )


@plan
def dim_sku_names(ods_sku_info, ods_spu_info, ods_base_category3, ods_base_category2, ods_base_category1, ods_base_trademark):
    """SKU with its product, brand and three category levels: what summaries and reports need of it."""
    third = ods_base_category3.select(F.col("id").alias("category3_id"), F.col("name").alias("category3_name"), "category2_id")
    second = ods_base_category2.select(F.col("id").alias("category2_id"), F.col("name").alias("category2_name"), "category1_id")
    first = ods_base_category1.select(F.col("id").alias("category1_id"), F.col("name").alias("category1_name"))
    spu = ods_spu_info.select(F.col("id").alias("spu_id"), "spu_name")
    brand = ods_base_trademark.select(F.col("id").alias("tm_id"), "tm_name")
    return (
        ods_sku_info.join(spu, "spu_id", "left").join(third, "category3_id", "left").join(second, "category2_id", "left")
        .join(first, "category1_id", "left").join(brand, "tm_id", "left")
    )


@plan
def dim_sku(dim_sku_names, ods_sku_attr_value, ods_sku_sale_attr_value):
    """SKU with its names and attribute lists; a list holds the attributes of one SKU."""

    def lists(df, columns, name):
        as_text = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
        return df.groupBy(F.col("sku_id").alias("id")).agg(F.array_sort(F.collect_set(as_text)).alias(name))

    attrs = lists(ods_sku_attr_value, ["attr_id", "value_id", "attr_name", "value_name"], "sku_attr_values")
    sale = lists(
        ods_sku_sale_attr_value,
        ["sale_attr_id", "sale_attr_value_id", "sale_attr_name", "sale_attr_value_name"],
        "sku_sale_attr_values",
    )
    return dim_sku_names.join(attrs, "id", "left").join(sale, "id", "left").select(
        "id", "price", "sku_name", "sku_desc", "weight", (F.col("is_sale") == "1").alias("is_sale"), "spu_id", "spu_name",
        "category3_id", "category3_name", "category2_id", "category2_name", "category1_id", "category1_name",
        "tm_id", "tm_name", "sku_attr_values", "sku_sale_attr_values", "create_time",
    )


@plan
def dim_user_zip(ods_user_info, log_as_of: dt.date):
    """Users with personal data masked, valid from the run date on."""
    return ods_user_info.select(
        "id", mask_name("name").alias("name"), mask_mobile("phone_num").alias("phone_num"),
        mask_email("email").alias("email"), "user_level", F.date_from_unix_date("birthday").alias("birthday"), "gender",
        "create_time", "operate_time", *opened(F.lit(log_as_of.isoformat())),
    )

"""Logistics dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratamart.functions.columns import (
    day_from_epoch_days, day_text, hash_email, hash_mobile, iso_to_text, millis_to_ts,
)
from stratamart.operators.lookups import with_columns_of
from stratamart.operators.scans import live
from stratamart.operators.zipper import opened
from stratamart.warehouse import plan


def tms_label(df, dic, code: str, name: str, how: str = "inner"):
    """Name of a numeric dictionary code that facts carry as text."""
    names = live(dic).select(F.col("id").cast("string").alias("_code"), F.col("name").alias(name))
    return df.join(names, F.col(code) == F.col("_code"), how).drop("_code")


@plan
def dim_complex(ods_tms_complex, ods_tms_region, ods_tms_courier_complex):
    region = live(ods_tms_region)
    couriers = live(ods_tms_courier_complex).groupBy(F.col("complex_id").alias("id")).agg(
        F.array_sort(F.collect_set(F.col("courier_emp_id").cast("string"))).alias("courier_emp_ids")
    )
    named = with_columns_of(live(ods_tms_complex), region, "province_id", "id", {"name": "province_name"}, "inner")
    named = with_columns_of(named, region, "city_id", "id", {"name": "city_name"}, "inner")
    return named.join(couriers, "id", "left").select(
        "id", "complex_name", "courier_emp_ids", "province_id", "province_name", "city_id", "city_name", "district_id", "district_name"
    )


@plan
def dim_organ(ods_tms_organ, ods_tms_region):
    organ = live(ods_tms_organ)
    named = with_columns_of(organ, live(ods_tms_region), "region_id", "id", {"name": "region_name", "dict_code": "region_code"})
    named = with_columns_of(named, organ, "org_parent_id", "id", {"org_name": "org_parent_name"})
    return named.select(
        "id", "org_name", "org_level", "region_id", "region_name", "region_code", "org_parent_id", "org_parent_name"
    )


@plan
def dim_region(ods_tms_region):
    return live(ods_tms_region).select("id", "parent_id", "name", "dict_code", "short_name")


@plan
def dim_express_courier(ods_tms_courier, ods_tms_organ, ods_tms_dic):
    courier = live(ods_tms_courier).withColumn("working_phone", F.md5("working_phone"))
    named = with_columns_of(courier, live(ods_tms_organ), "org_id", "id", {"org_name": "org_name"}, "inner")
    return tms_label(named, ods_tms_dic, "express_type", "express_type_name").select(
        "id", "emp_id", "org_id", "org_name", "working_phone", "express_type", "express_type_name"
    )


@plan
def dim_shift(ods_tms_shift, ods_tms_line, ods_tms_dic):
    line = live(ods_tms_line).drop("is_deleted").withColumnRenamed("id", "line_id").withColumnRenamed("name", "line_name")
    named = tms_label(live(ods_tms_shift).join(line, "line_id"), ods_tms_dic, "transport_line_type_id", "transport_line_type_name")
    return named.select(
        "id", "line_id", "line_name", "line_no", "line_level", "org_id", "transport_line_type_id", "transport_line_type_name",
        "start_org_id", "start_org_name", "end_org_id", "end_org_name", "pair_line_id", "distance", "cost", "estimated_time",
        "start_time", "driver1_emp_id", "driver2_emp_id", "truck_id", "pair_shift_id",
    )


@plan
def dim_truck_driver(ods_tms_driver, ods_tms_organ, ods_tms_team):
    named = with_columns_of(live(ods_tms_driver), live(ods_tms_organ), "org_id", "id", {"org_name": "org_name"}, "inner")
    named = with_columns_of(named, live(ods_tms_team), "team_id", "id", {"name": "team_name"}, "inner")
    return named.select(
        "id", "emp_id", "org_id", "org_name", "team_id", "team_name", "license_type", "init_license_date", "expire_date",
        "license_no", "is_enabled",
    )


@plan
def dim_truck(ods_tms_truck, ods_tms_team, ods_tms_model, ods_tms_organ, ods_tms_dic):
    truck = live(ods_tms_truck).withColumn("truck_no", F.md5("truck_no"))
    team = {"name": "team_name", "team_no": "team_no", "org_id": "org_id", "manager_emp_id": "manager_emp_id"}
    model = {
        "model_name": "truck_model_name", "model_type": "truck_model_type", "model_no": "truck_model_no", "brand": "truck_brand",
        **{c: c for c in ("truck_weight", "load_weight", "total_weight", "eev", "boxcar_len", "boxcar_wd", "boxcar_hg", "max_speed", "oil_vol")},
    }
    named = with_columns_of(truck, live(ods_tms_team), "team_id", "id", team, "inner")
    named = with_columns_of(named, live(ods_tms_model), "truck_model_id", "id", model, "inner")
    named = with_columns_of(named, live(ods_tms_organ), "org_id", "id", {"org_name": "org_name"}, "inner")
    named = tms_label(named, ods_tms_dic, "truck_model_type", "truck_model_type_name")
    named = tms_label(named, ods_tms_dic, "truck_brand", "truck_brand_name")
    return named.select(
        "id", "team_id", "team_name", "team_no", "org_id", "org_name", "manager_emp_id", "truck_no", "truck_model_id",
        "truck_model_name", "truck_model_type", "truck_model_type_name", "truck_model_no", "truck_brand", "truck_brand_name",
        "truck_weight", "load_weight", "total_weight", "eev", "boxcar_len", "boxcar_wd", "boxcar_hg", "max_speed", "oil_vol",
        "device_gps_id", "engine_no", "license_registration_date", "license_last_check_date", "license_expire_date", "is_enabled",
    )


@plan
def dim_user_zip_tms(ods_tms_user):
    """Users with personal data hashed; rows that fail the format check are hashed as null."""
    return live(ods_tms_user).select(
        "id", "login_name", "nick_name", F.md5("passwd").alias("passwd"), F.md5("real_name").alias("realname"),
        hash_mobile("phone_num").alias("phone_num"), hash_email("email").alias("email"), "user_level",
        day_from_epoch_days("birthday").alias("birthday"), "gender", *opened(day_text(millis_to_ts("create_time"))),
    )


@plan
def dim_user_address_zip(ods_tms_address):
    return live(ods_tms_address).select(
        "id", "user_id", hash_mobile("phone").alias("phone"), "province_id", "city_id", "district_id", "complex_id", "address",
        "is_default", *opened(iso_to_text("create_time")),
    )

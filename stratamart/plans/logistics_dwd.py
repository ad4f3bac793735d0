"""Logistics detail facts: one row per cargo of a waybill, at each step of its life."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratamart.functions.columns import OPEN_END, day_text, iso_to_text, mask_name, millis_to_ts, second_text
from stratamart.operators.scans import live
from stratamart.plans.logistics_dim import tms_label
from stratamart.warehouse import plan

# Waybill states.
CREATED, PAID_CANCELLED, CLOSED_BY_SYSTEM = "60010", "60020", "60999"
NOT_PAID = ["60010", "60999"]
NOT_RECEIVED = ["60010", "60020", "60999"]
NOT_DISPATCHED = ["60010", "60020", "60030", "60040", "60999"]
NOT_BOUND = ["60020", "60030", "60040", "60050"]
NOT_DELIVERED = ["60020", "60030", "60040"]
ENDED = ["60020", "60030"]

CARGO = ["cargo_type", "cargo_type_name", "volume_length", "volume_width", "volume_height", "weight"]
PARTIES = [
    "receiver_complex_id", "receiver_province_id", "receiver_city_id", "receiver_district_id", "receiver_name",
    "sender_complex_id", "sender_province_id", "sender_city_id", "sender_district_id", "sender_name",
]
MONEY = ["cargo_num", "amount", "estimate_arrive_time", "distance"]


def _waybills(cargo: DataFrame, order: DataFrame, dic: DataFrame) -> DataFrame:
    """Cargo joined to its waybill.  Labels go on the waybill, before the join to many cargos."""
    info = live(order).select(
        F.col("id").alias("order_id"), "order_no", "status", "collect_type", "user_id", *PARTIES, "payment_type", *MONEY, "update_time"
    )
    info = info.withColumns({
        "receiver_name": mask_name("receiver_name"),
        "sender_name": mask_name("sender_name"),
        "estimate_arrive_time": second_text(millis_to_ts("estimate_arrive_time")),
        "update_time": iso_to_text("update_time"),
    })
    for code in ("status", "collect_type", "payment_type"):
        info = tms_label(info, dic, code, f"{code}_name", "left")
    goods = live(cargo).select(
        "id", "order_id", "cargo_type", "volume_length", "volume_width", "volume_height", "weight",
        iso_to_text("create_time").alias("order_time"),
    )
    return tms_label(goods, dic, "cargo_type", "cargo_type_name", "left").join(info, "order_id")


def _step(waybills: DataFrame, time: str, keep) -> DataFrame:
    """Waybills that reached a step; the step time is the last update."""
    return waybills.filter(keep).select(
        "id", "order_id", *CARGO, F.col("update_time").alias(time), "order_no", "status", "status_name", "collect_type",
        "collect_type_name", "user_id", *PARTIES, "payment_type", "payment_type_name", *MONEY,
        F.substring("update_time", 1, 10).cast("date").alias("dt"),
    )


def _not_in(states):
    return ~F.col("status").isin(states)


@plan
def dwd_tms_order_detail(ods_tms_cargo, ods_tms_order, ods_tms_dic):
    return _waybills(ods_tms_cargo, ods_tms_order, ods_tms_dic).select(
        "id", "order_id", *CARGO, "order_time", "order_no", "status", "status_name", "collect_type", "collect_type_name", "user_id",
        *PARTIES, *MONEY, F.substring("order_time", 1, 10).cast("date").alias("dt"),
    )


@plan
def dwd_tms_pay_suc(ods_tms_cargo, ods_tms_order, ods_tms_dic):
    return _step(_waybills(ods_tms_cargo, ods_tms_order, ods_tms_dic), "payment_time", _not_in(NOT_PAID))


@plan
def dwd_tms_order_cancel(ods_tms_cargo, ods_tms_order, ods_tms_dic):
    return _step(_waybills(ods_tms_cargo, ods_tms_order, ods_tms_dic), "cancel_time", F.col("status") == PAID_CANCELLED)


@plan
def dwd_tms_receive(ods_tms_cargo, ods_tms_order, ods_tms_dic):
    return _step(_waybills(ods_tms_cargo, ods_tms_order, ods_tms_dic), "receive_time", _not_in(NOT_RECEIVED))


@plan
def dwd_tms_dispatch(ods_tms_cargo, ods_tms_order, ods_tms_dic):
    return _step(_waybills(ods_tms_cargo, ods_tms_order, ods_tms_dic), "dispatch_time", _not_in(NOT_DISPATCHED))


@plan
def dwd_tms_bound_finish(ods_tms_cargo, ods_tms_order, ods_tms_dic):
    return _step(_waybills(ods_tms_cargo, ods_tms_order, ods_tms_dic), "bound_finish_time", _not_in(NOT_BOUND))


@plan
def dwd_tms_deliver_suc(ods_tms_cargo, ods_tms_order, ods_tms_dic):
    return _step(_waybills(ods_tms_cargo, ods_tms_order, ods_tms_dic), "deliver_suc_time", _not_in(NOT_DELIVERED))


@plan
def dwd_tms_sign(ods_tms_cargo, ods_tms_order, ods_tms_dic):
    return _step(_waybills(ods_tms_cargo, ods_tms_order, ods_tms_dic), "sign_time", _not_in(NOT_BOUND))


@plan
def dwd_tms_order_process(ods_tms_cargo, ods_tms_order, ods_tms_dic):
    """Accumulating snapshot: a waybill stays in the open partition until it ends."""
    ended = F.col("status").isin(ENDED)
    return _waybills(ods_tms_cargo, ods_tms_order, ods_tms_dic).select(
        "id", "order_id", *CARGO, "order_time", "order_no", "status", "status_name", "collect_type", "collect_type_name", "user_id",
        *PARTIES, "payment_type", "payment_type_name", *MONEY, F.substring("order_time", 1, 10).alias("start_date"),
        F.when(ended, F.substring("update_time", 1, 10)).otherwise(OPEN_END).alias("end_date"),
    )


@plan
def dwd_tms_trans_finish(ods_tms_task, dim_shift):
    """Finished transport tasks.  The shift is looked up for its planned time."""
    done = live(ods_tms_task).filter(F.col("actual_end_time").isNotNull())
    shift = dim_shift.select(F.col("id").alias("shift_id"), "estimated_time")
    return done.join(shift, "shift_id", "left").select(
        "id", "shift_id", "line_id", "start_org_id", "start_org_name", "end_org_id", "end_org_name", "order_num",
        "driver1_emp_id", mask_name("driver1_name").alias("driver1_name"), "driver2_emp_id", mask_name("driver2_name").alias("driver2_name"),
        "truck_id", F.md5("truck_no").alias("truck_no"), second_text(millis_to_ts("actual_start_time")).alias("actual_start_time"),
        second_text(millis_to_ts("actual_end_time")).alias("actual_end_time"), "estimated_time", "actual_distance",
        F.expr("(actual_end_time - actual_start_time) div 1000").alias("finish_dur_sec"),
        millis_to_ts("actual_end_time").cast("date").alias("dt"),
    )


def _bound(df: DataFrame, time: str, who: str) -> DataFrame:
    at = millis_to_ts(time)
    return live(df).filter(F.col(time).isNotNull()).select(
        "id", "order_id", "org_id", second_text(at).alias(time), who, at.cast("date").alias("dt")
    )


@plan
def dwd_tms_inbound(ods_tms_bound):
    return _bound(ods_tms_bound, "inbound_time", "inbound_emp_id")


@plan
def dwd_tms_sort(ods_tms_bound):
    return _bound(ods_tms_bound, "sort_time", "sorter_emp_id")


@plan
def dwd_tms_outbound(ods_tms_bound):
    return _bound(ods_tms_bound, "outbound_time", "outbound_emp_id")

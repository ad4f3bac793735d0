"""Logistics reports over 1, 7 and 30 days."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratamart.functions.columns import rate_or_null
from stratamart.operators.merge import signed_balance, stack_sums
from stratamart.operators.windows import recent_days
from stratamart.plans.logistics_dws import _with_level_place
from stratamart.warehouse import plan

TRIP = ["trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec"]
TRIP_TYPES = {"trans_finish_count": "bigint", "trans_finish_distance": "decimal(24,2)", "trans_finish_dur_sec": "bigint"}
ORDER_TYPES = {"order_count": "bigint", "order_amount": "decimal(28,2)"}


def _windows(daily: DataFrame, as_of, keys, measures: dict[str, str], spans=(1, 7, 30)) -> DataFrame:
    """Daily summary copied into each window it belongs to; ``measures`` maps input to output name.

    All windows come from the one-day layer: it is read once, and the sums that
    follow combine the copies before their shuffle.
    """
    copies = recent_days(daily, as_of, spans)
    return copies.select(*keys, "recent_days", *[F.col(c).alias(name) for c, name in measures.items()])


def _report(keys, inputs, measures, as_of) -> DataFrame:
    return stack_sums([*keys, "recent_days"], inputs, measures).withColumn("dt", F.lit(as_of))


def _with_averages(df: DataFrame) -> DataFrame:
    count = F.col("trans_finish_count")
    return df.withColumns({
        "avg_trans_finish_distance": rate_or_null("trans_finish_distance", count),
        "avg_trans_finish_dur_sec": rate_or_null("trans_finish_dur_sec", count),
    })


@plan
def ads_tms_trans_order_stats(dws_tms_org_receive_1d, dws_tms_dispatch_1d, as_of):
    receive = _windows(dws_tms_org_receive_1d, as_of, [], {"order_count": "receive_order_count", "order_amount": "receive_order_amount"})
    dispatch = _windows(dws_tms_dispatch_1d, as_of, [], {"order_count": "dispatch_order_count", "order_amount": "dispatch_order_amount"})
    measures = {f"{side}_order_{m}": t for side in ("receive", "dispatch") for m, t in (("count", "bigint"), ("amount", "decimal(28,2)"))}
    return _report([], [receive, dispatch], measures, as_of)


def _trips(truck_1d: DataFrame, as_of, keys) -> DataFrame:
    return _windows(truck_1d, as_of, keys, {"truck_finish_count": "trans_finish_count", **{m: m for m in TRIP[1:]}})


@plan
def ads_tms_trans_stats(dws_tms_truck_finish_1d, as_of):
    return _report([], [_trips(dws_tms_truck_finish_1d, as_of, [])], TRIP_TYPES, as_of)


@plan
def ads_tms_order_stats_td(dws_tms_dispatch_td, dws_tms_bound_finish_td, as_of):
    """Waybills under way: dispatched less finished."""
    balance = signed_balance(dws_tms_dispatch_td, dws_tms_bound_finish_td, ["order_count", "order_amount"])
    return balance.select(
        F.col("order_count").alias("bounding_order_count"), F.col("order_amount").alias("bounding_order_amount"), F.lit(as_of).alias("dt")
    )


def _orders(daily, as_of, keys):
    return _windows(daily, as_of, keys, {"order_count": "order_count", "order_amount": "order_amount"})


@plan
def ads_tms_order_stats(dws_tms_org_cargo_order_1d, as_of):
    return _report([], [_orders(dws_tms_org_cargo_order_1d, as_of, [])], ORDER_TYPES, as_of)


@plan
def ads_tms_cargo_type_stats(dws_tms_org_cargo_order_1d, as_of):
    keys = ["cargo_type", "cargo_type_name"]
    return _report(keys, [_orders(dws_tms_org_cargo_order_1d, as_of, keys)], ORDER_TYPES, as_of)


@plan
def ads_tms_city_stats(dws_tms_org_cargo_order_1d, dws_tms_truck_finish_1d, dim_organ, dim_region, as_of):
    """Orders and trips per city; a trip belongs to the city of the organisation it left from."""
    keys = ["city_id", "city_name"]
    orders = _orders(dws_tms_org_cargo_order_1d, as_of, keys)
    trips = _report(["org_id", "org_name"], [_trips(dws_tms_truck_finish_1d, as_of, ["org_id", "org_name"])], TRIP_TYPES, as_of)
    placed = _with_level_place(trips, dim_organ, dim_region)
    return _with_averages(_report(keys, [orders, placed], {**ORDER_TYPES, **TRIP_TYPES}, as_of))


@plan
def ads_tms_org_stats(dws_tms_org_cargo_order_1d, dws_tms_truck_finish_1d, as_of):
    keys = ["org_id", "org_name"]
    inputs = [_orders(dws_tms_org_cargo_order_1d, as_of, keys), _trips(dws_tms_truck_finish_1d, as_of, keys)]
    return _with_averages(_report(keys, inputs, {**ORDER_TYPES, **TRIP_TYPES}, as_of))


@plan
def ads_tms_shift_stats(dws_tms_shift_finish_nd, as_of):
    return dws_tms_shift_finish_nd.select("recent_days", "shift_id", *TRIP, "trans_finish_order_count", F.lit(as_of).alias("dt"))


def _per_window(df: DataFrame, keys, measures, as_of) -> DataFrame:
    return df.groupBy(*keys, "recent_days").agg(*[F.sum(m).alias(m) for m in measures]).withColumn("dt", F.lit(as_of))


@plan
def ads_tms_line_stats(dws_tms_shift_finish_nd, as_of):
    return _per_window(dws_tms_shift_finish_nd, ["line_id", "line_name"], [*TRIP, "trans_finish_order_count"], as_of)


@plan
def ads_tms_driver_stats(dws_tms_shift_finish_nd, as_of):
    """Trips per driver.  Two drivers of one trip share its distance and time; each made the trip."""
    two = F.col("driver2_emp_id").isNotNull()
    first = F.struct(F.col("driver1_emp_id").alias("driver_emp_id"), F.col("driver1_name").alias("driver_name"))
    second = F.struct(F.col("driver2_emp_id").alias("driver_emp_id"), F.col("driver2_name").alias("driver_name"))
    share = F.when(two, 2).otherwise(1)
    split = dws_tms_shift_finish_nd.select(
        "recent_days", "trans_finish_count",
        (F.col("trans_finish_distance") / share).cast("decimal(24,3)").alias("trans_finish_distance"),
        (F.col("trans_finish_dur_sec") / share).cast("decimal(24,1)").alias("trans_finish_dur_sec"),
        F.inline(F.when(two, F.array(first, second)).otherwise(F.array(first))),
    )
    return _with_averages(_per_window(split, ["driver_emp_id", "driver_name"], TRIP, as_of))


@plan
def ads_tms_truck_stats(dws_tms_shift_finish_nd, as_of):
    keys = ["truck_model_type", "truck_model_type_name"]
    return _with_averages(_per_window(dws_tms_shift_finish_nd, keys, TRIP, as_of))


def _express(receive, deliver, sort, keys, as_of) -> DataFrame:
    inputs, measures = [], {}
    if receive is not None:
        inputs.append(_windows(receive, as_of, keys, {"order_count": "receive_order_count", "order_amount": "receive_order_amount"}))
        measures |= {"receive_order_count": "bigint", "receive_order_amount": "decimal(28,2)"}
    inputs.append(_windows(deliver, as_of, keys, {"order_count": "deliver_suc_count"}))
    inputs.append(_windows(sort, as_of, keys, {"sort_count": "sort_count"}))
    return _report(keys, inputs, {**measures, "deliver_suc_count": "bigint", "sort_count": "bigint"}, as_of)


@plan
def ads_tms_express_stats(dws_tms_org_deliver_1d, dws_tms_org_sort_1d, as_of):
    return _express(None, dws_tms_org_deliver_1d, dws_tms_org_sort_1d, [], as_of)


@plan
def ads_tms_express_province(dws_tms_org_receive_1d, dws_tms_org_deliver_1d, dws_tms_org_sort_1d, as_of):
    keys = ["province_id", "province_name"]
    return _express(dws_tms_org_receive_1d, dws_tms_org_deliver_1d, dws_tms_org_sort_1d, keys, as_of)


@plan
def ads_tms_express_city(dws_tms_org_receive_1d, dws_tms_org_deliver_1d, dws_tms_org_sort_1d, as_of):
    return _express(dws_tms_org_receive_1d, dws_tms_org_deliver_1d, dws_tms_org_sort_1d, ["city_id", "city_name"], as_of)


@plan
def ads_tms_express_org(dws_tms_org_receive_1d, dws_tms_org_deliver_1d, dws_tms_org_sort_1d, as_of):
    return _express(dws_tms_org_receive_1d, dws_tms_org_deliver_1d, dws_tms_org_sort_1d, ["org_id", "org_name"], as_of)

"""Coupon statements."""

SQL: dict[str, str] = {}

_SK = "CAST('0x' || left(md5(CAST({k} AS VARCHAR)), 15) AS BIGINT)"
SQL["dim_customer_service"] = f"""
SELECT *, {_SK.format(k="customer_service_id")} AS surrogate_key, :as_of AS effective_date, :as_of + 3650 AS expiry_date, TRUE AS is_current, 1 AS version
FROM {{ods_cs_agent}} WHERE status IS NOT NULL"""
SQL["dim_cs_activity"] = f"""
SELECT *, {_SK.format(k="activity_id")} AS activity_sk,
       CASE activity_level WHEN '商品级' THEN 'Product Level' WHEN 'SKU级' THEN 'SKU Level' ELSE 'Unknown' END AS activity_level_desc,
       CASE activity_status WHEN '进行中' THEN 'Active' WHEN '已结束' THEN 'Ended' WHEN '已暂停' THEN 'Paused' ELSE 'Unknown' END AS activity_status_desc,
       CASE coupon_type WHEN '固定优惠' THEN 'Fixed Discount' WHEN '自定义优惠' THEN 'Custom Discount' ELSE 'Unknown' END AS coupon_type_desc,
       CAST(activity_end_time AS DATE) - CAST(activity_start_time AS DATE) AS activity_duration FROM {{ods_cs_activity}}"""
SQL["dim_cs_customer"] = "SELECT * FROM {ods_cs_customer}"
SQL["dwd_coupon_send"] = """
SELECT send_id, activity_id, product_id, sku_id, customer_service_id, customer_id, CAST(coupon_amount AS DECIMAL(10,2)) AS coupon_amount, send_time, expire_time,
       usage_valid_hours, send_channel, remark, send_status, CAST(send_time AS DATE) AS send_date, hour(send_time) AS send_hour, CAST(send_time AS DATE) AS dt FROM {ods_cs_send}"""
SQL["dwd_coupon_usage"] = """
SELECT *, CAST(usage_time AS DATE) AS usage_date, hour(usage_time) AS usage_hour, order_amount - actual_payment AS save_amount, CAST(usage_time AS DATE) AS dt FROM {ods_cs_usage}"""
SQL["dwd_activity_product"] = "SELECT *, product_status = '有效' AND remove_time IS NULL AS is_valid FROM {ods_cs_product}"
_AGENTS = "(SELECT customer_service_id, customer_service_name, department, position FROM {ods_cs_agent} WHERE status IS NOT NULL)"
SQL["dwd_cs_performance"] = f"""
SELECT a.*, coalesce(s.n, 0) AS send_count, coalesce(u.n, 0) AS usage_count, coalesce(s.amount, 0) AS total_coupon_amount, coalesce(u.saved, 0) AS total_save_amount,
       CASE WHEN s.n > 0 THEN RATE(coalesce(u.n, 0), s.n, 4) ELSE 0.0 END AS conversion_rate,
       CASE WHEN s.n > 0 THEN RATE(s.amount, s.n, 2) ELSE 0.0 END AS avg_coupon_amount
FROM {_AGENTS} a LEFT JOIN (SELECT customer_service_id, count(*) AS n, sum(coupon_amount) AS amount FROM {{dwd_coupon_send}} GROUP BY ALL) s USING (customer_service_id)
LEFT JOIN (SELECT customer_service_id, count(*) AS n, sum(save_amount) AS saved FROM {{dwd_coupon_usage}} GROUP BY ALL) u USING (customer_service_id)"""
SQL["dws_cs_performance"] = """
SELECT p.*, coalesce(o.customers, 0) AS customer_count, coalesce(o.n, 0) AS order_count, coalesce(o.amount, 0) AS total_order_amount,
       coalesce(RATE(o.amount, o.n, 2), 0) AS avg_order_amount
FROM {dwd_cs_performance} p LEFT JOIN (SELECT customer_service_id, count(DISTINCT customer_id) AS customers, count(order_id) AS n, sum(order_amount) AS amount
  FROM {dwd_coupon_usage} GROUP BY ALL) o USING (customer_service_id)"""


def _effect(keys, head, tail):
    return f"""
SELECT {head}, coalesce(s.n, 0) AS send_count, coalesce(u.n, 0) AS usage_count, coalesce(s.amount, 0) AS total_coupon_amount, coalesce(u.saved, 0) AS total_save_amount,
       CASE WHEN s.n > 0 THEN RATE(coalesce(u.n, 0), s.n, 4) ELSE 0.0 END AS conversion_rate, coalesce(s.customers, 0) AS customer_count,
       coalesce(u.orders, 0) AS order_count, coalesce(u.amount, 0) AS total_order_amount, coalesce(RATE(u.amount, u.n, 2), 0) AS avg_order_amount, {tail}
LEFT JOIN (SELECT {keys}, count(*) AS n, sum(coupon_amount) AS amount, count(DISTINCT customer_id) AS customers FROM {{dwd_coupon_send}} GROUP BY ALL) s USING ({keys})
LEFT JOIN (SELECT {keys}, count(*) AS n, sum(save_amount) AS saved, count(DISTINCT order_id) AS orders, sum(order_amount) AS amount FROM {{dwd_coupon_usage}} GROUP BY ALL) u USING ({keys})"""


SQL["dws_activity_effect"] = _effect(
    "activity_id", "a.activity_id, a.activity_name, a.activity_level, a.activity_status",
    "CASE WHEN u.saved > 0 THEN RATE(u.amount, u.saved, 4) ELSE 0.0 END AS roi FROM {ods_cs_activity} a",
)
SQL["dws_product_coupon"] = _effect(
    "product_id, sku_id", "product_id, sku_id",
    "CASE WHEN u.amount > 0 THEN RATE(u.saved, (u.amount + u.saved), 4) ELSE 0.0 END AS avg_discount_rate FROM {ods_cs_product} a",
)


def _spans(key):
    out = []
    for n in (7, 30):
        s = f"FROM {{dwd_coupon_send}} WHERE {key} = a.{key} AND dt > :as_of - {n} AND dt <= :as_of"
        u = s.replace("send", "usage")
        out += [f"(SELECT count(*) {s}) AS send_count_{n}d", f"(SELECT count(*) {u}) AS usage_count_{n}d",
                f"coalesce((SELECT sum(coupon_amount) {s}), 0) AS total_coupon_amount_{n}d", f"coalesce((SELECT sum(save_amount) {u}), 0) AS total_save_amount_{n}d"]
    return ", ".join(out)


SQL["ads_activity_daily"] = f"SELECT :as_of AS stat_date, activity_id, activity_name, {_spans('activity_id')} FROM {{ods_cs_activity}} a"
SQL["agent_spans"] = f"SELECT :as_of AS stat_date, a.*, {_spans('customer_service_id')} FROM {_AGENTS} a"
_CONV = ", ".join(f"CASE WHEN send_count_{n}d > 0 THEN RATE(usage_count_{n}d, send_count_{n}d, 4) ELSE 0.0 END AS conversion_rate_{n}d" for n in (7, 30))
SQL["ads_cs_coupon_stats"] = f"SELECT *, {_CONV} FROM {{agent_spans}}"
_WHO = "stat_date, customer_service_id, customer_service_name, department, position"
SQL["ads_cs_send_stats"] = f"SELECT {_WHO}, send_count_7d, send_count_30d FROM {{agent_spans}}"
SQL["ads_cs_usage_stats"] = f"SELECT {_WHO}, usage_count_7d, usage_count_30d FROM {{agent_spans}}"
SQL["ads_coupon_send_usage_detail"] = """
SELECT :as_of AS stat_date, s.send_id, u.usage_id, s.activity_id, s.product_id, s.sku_id, s.customer_service_id, s.customer_id, s.coupon_amount, s.send_time,
       u.usage_time, u.order_id, u.order_amount, u.actual_payment, u.save_amount, s.send_status, u.order_status
FROM {dwd_coupon_send} s LEFT JOIN {dwd_coupon_usage} u ON u.send_id = s.send_id"""
_T = []
for _n in (7, 30):
    _r = f"dt > :as_of - {_n} AND dt <= :as_of"
    _T += [f"(SELECT count(*) FROM {{dwd_coupon_send}} WHERE {_r}) AS total_send_count_{_n}d", f"(SELECT count(*) FROM {{dwd_coupon_usage}} WHERE {_r}) AS total_usage_count_{_n}d",
           f"(SELECT count(DISTINCT order_id) FROM {{dwd_coupon_usage}} WHERE {_r}) AS total_order_count_{_n}d"]
SQL["ads_time_period_summary"] = f"SELECT :as_of AS stat_date, {', '.join(_T)}"

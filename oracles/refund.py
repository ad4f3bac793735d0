"""Refund topic statements."""

SQL: dict[str, str] = {}

SQL["rf_log_route"] = """
SELECT CASE WHEN broken OR type = 'other' THEN 'dirty' ELSE type END AS route, value FROM (
  SELECT *, CASE WHEN broken THEN '{broken ' || event_id ELSE '{"type":"' || type || '","event_id":' || event_id || '}' END AS value FROM {v_rf_log})
UNION ALL SELECT 'all', '{"type":"' || type || '","event_id":' || event_id || '}' FROM {v_rf_log} WHERE NOT broken"""
SQL["rf_ods_tables"] = """
SELECT 'ods_order' AS table_name, CAST(sync_time AS DATE) AS dt, count(*) AS row_count FROM {ods_rf_order} GROUP BY ALL
UNION ALL SELECT 'ods_refund', CAST(sync_time AS DATE), count(*) FROM {ods_rf_refund} GROUP BY ALL
UNION ALL SELECT 'ods_logistics', CAST(sync_time AS DATE), count(*) FROM {ods_rf_logistics} GROUP BY ALL
UNION ALL SELECT CASE WHEN behavior_type = 'error' THEN 'ods_error_data' ELSE 'ods_user_behavior' END, CAST(sync_time AS DATE), count(*) FROM {ods_rf_behavior} GROUP BY ALL"""
SQL["rf_ods_error_data"] = """
SELECT md5('ods_user_behavior|' || raw) AS error_id, 'ods_user_behavior' AS table_name, CASE WHEN user_id IS NULL THEN 'user_id' ELSE 'behavior_type' END AS error_field,
       CASE WHEN user_id IS NULL THEN 'missing user' ELSE 'unknown behaviour type' END AS error_reason, raw AS raw_data, sync_time AS create_time, CAST(sync_time AS DATE) AS dt
FROM (SELECT *, concat_ws('|', behavior_id, user_id, behavior_type, page_url) AS raw FROM {ods_rf_behavior}) WHERE user_id IS NULL OR behavior_type NOT IN ('view', 'click', 'purchase', 'signup')"""
_RPO = """(SELECT order_id, sum(refund_amount) AS refund_amount, arg_max(refund_status, (refund_apply_time, refund_id)) AS refund_status, count(*) AS refund_count
  FROM {ods_rf_refund} GROUP BY order_id)"""
SQL["rf_dwd_order_wide"] = f"""
SELECT o.order_id, o.user_id, o.sku_id, o.order_amount, o.pay_time, o.commit_ship_time, o.order_status, o.create_time, o.data_source, r.refund_amount, r.refund_status,
       r.refund_count, l.logistics_node, l.node_time, l.express_company, b.behavior_type, b.behavior_time, b.page_url
FROM {{ods_rf_order}} o LEFT JOIN {_RPO} r USING (order_id) LEFT JOIN {{ods_rf_logistics}} l USING (order_id)
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY behavior_time DESC, behavior_id DESC) AS rn FROM {{ods_rf_behavior}}) b ON b.user_id = o.user_id AND b.rn = 1"""
SQL["rf_dwd_refund_wide"] = """
SELECT r.refund_id, r.order_id, r.user_id, r.refund_amount, r.refund_status, r.refund_apply_time, r.user_input_reason, r.refund_finish_time, r.data_source,
       o.order_amount, o.order_status, o.pay_time, l.logistics_node, l.node_time, l.express_company
FROM {ods_rf_refund} r LEFT JOIN {ods_rf_order} o ON o.order_id = r.order_id
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY node_time DESC, logistics_id DESC) AS rn FROM {ods_rf_logistics}) l ON l.order_id = r.order_id AND l.rn = 1"""
SQL["rf_dwd_behavior_wide"] = """
SELECT b.behavior_id, b.user_id, b.behavior_type, b.behavior_time, b.page_url, b.data_source, o.order_count, o.order_amount, o.last_order_id, o.last_order_status
FROM {ods_rf_behavior} b LEFT JOIN (SELECT user_id, count(*) AS order_count, sum(order_amount) AS order_amount, arg_max(order_id, (create_time, order_id)) AS last_order_id,
  arg_max(order_status, (create_time, order_id)) AS last_order_status FROM {ods_rf_order} GROUP BY user_id) o USING (user_id)"""
SQL["rf_dws_order_by_user"] = """
SELECT user_id, count(*) AS order_count, sum(order_amount) AS total_order_amount, RATE(sum(order_amount), count(*), 2) AS avg_order_amount,
       max(order_amount) AS max_order_amount, min(order_amount) AS min_order_amount, min(create_time) AS first_order_time, max(create_time) AS last_order_time,
       bool_or(order_id IN (SELECT order_id FROM {ods_rf_refund} GROUP BY order_id HAVING sum(refund_amount) > 0)) AS has_refund_order, max(data_source) AS data_source
FROM {ods_rf_order} GROUP BY user_id"""
SQL["rf_dws_refund_by_user"] = """
SELECT r.user_id, r.n AS refund_count, r.amount AS total_refund_amount, RATE(r.amount, r.n, 2) AS avg_refund_amount,
       coalesce(RATE(r.n * 100, o.n, 2), 0) AS refund_rate, RATE(r.n * 100, (SELECT count(DISTINCT user_id) FROM {ods_rf_refund}), 4) AS refund_share,
       r.f AS first_refund_time, r.l AS last_refund_time, r.data_source
FROM (SELECT user_id, count(*) AS n, sum(refund_amount) AS amount, min(refund_apply_time) AS f, max(refund_apply_time) AS l, max(data_source) AS data_source FROM {ods_rf_refund} GROUP BY ALL) r
LEFT JOIN (SELECT user_id, count(*) AS n FROM {ods_rf_order} GROUP BY user_id) o USING (user_id)"""
SQL["rf_dws_logistics"] = """
SELECT express_company, count(*) AS delivery_count, count(*) FILTER (WHERE node_time <= create_time + INTERVAL 3 DAY) AS on_time_delivery_count, max(l.data_source) AS data_source,
       RATE(100 * count(*) FILTER (WHERE node_time <= create_time + INTERVAL 3 DAY), count(*), 2) AS on_time_delivery_rate
FROM {ods_rf_logistics} l JOIN {ods_rf_order} o ON o.order_id = l.order_id WHERE express_company IS NOT NULL AND node_time IS NOT NULL AND create_time IS NOT NULL GROUP BY express_company"""
SQL["rf_dws_behavior"] = """
SELECT user_id, count(*) AS behavior_count, count(DISTINCT behavior_type) AS distinct_behavior_types, min(behavior_time) AS first_behavior_time,
       max(behavior_time) AS last_behavior_time, max(data_source) AS data_source FROM {ods_rf_behavior} GROUP BY user_id"""
SQL["rf_dws_status_refund"] = f"""
SELECT o.order_status, count(*) AS order_count, count(r.order_id) AS refund_order_count, RATE(100 * count(r.order_id), count(*), 2) AS refund_rate,
       coalesce(RATE(sum(r.refund_amount), sum(r.refund_count), 2), 0) AS avg_refund_amount, max(o.data_source) AS data_source
FROM {{ods_rf_order}} o LEFT JOIN {_RPO} r ON r.order_id = o.order_id GROUP BY o.order_status"""
SQL["rf_ads_user_profile"] = """
SELECT o.user_id, o.order_count, coalesce(r.refund_count, 0) AS refund_count, o.total_order_amount, coalesce(r.total_refund_amount, 0) AS total_refund_amount, o.avg_order_amount,
       coalesce(r.refund_rate, 0) AS refund_rate, o.first_order_time, o.last_order_time, r.first_refund_time, r.last_refund_time, coalesce(r.refund_rate, 0) > 50 AS is_risk_user,
       CASE WHEN o.total_order_amount >= 10000 THEN 'high' WHEN o.total_order_amount >= 5000 THEN 'medium' ELSE 'low' END AS user_value_level, o.data_source
FROM {rf_dws_order_by_user} o LEFT JOIN {rf_dws_refund_by_user} r USING (user_id)"""
SQL["rf_ads_carrier_eval"] = """
SELECT *, CASE WHEN on_time_delivery_rate >= 95 THEN 'excellent' WHEN on_time_delivery_rate >= 90 THEN 'good' WHEN on_time_delivery_rate >= 80 THEN 'fair' ELSE 'poor' END AS service_level
FROM {rf_dws_logistics}"""
SQL["rf_ads_status_analysis"] = """
SELECT *, CASE order_status WHEN 'completed' THEN '已完成' WHEN 'cancelled' THEN '已取消' WHEN 'refunded' THEN '已退款' WHEN 'pending' THEN '待处理' WHEN 'shipped' THEN '已发货' ELSE '其他' END
  AS status_description FROM {rf_dws_status_refund}"""
_M = [
    ("total_orders", "总订单数", "(SELECT count(*) FROM {ods_rf_order})"), ("total_refunds", "总退款数", "(SELECT count(*) FROM {ods_rf_refund})"),
    ("total_order_amount", "订单总金额", "(SELECT sum(order_amount) FROM {ods_rf_order})"), ("total_refund_amount", "退款总金额", "(SELECT sum(refund_amount) FROM {ods_rf_refund})"),
    ("avg_order_amount", "平均订单金额", "(SELECT RATE(sum(CAST(avg_order_amount AS DECIMAL(20,2))), count(avg_order_amount), 2) FROM {rf_dws_order_by_user})"),
    ("overall_refund_rate", "整体退款率", "RATE(100 * (SELECT count(*) FROM {ods_rf_refund}), (SELECT count(*) FROM {ods_rf_order}), 2)"),
]
SQL["rf_ads_overall_metrics"] = " UNION ALL ".join(
    f"SELECT '{n}' AS metric_name, CAST({v} AS DOUBLE) AS metric_value, '{d}' AS metric_desc, 'mysql' AS data_source" for n, d, v in _M
)
SQL["rf_ads_behavior_trend"] = """
SELECT CAST(behavior_time AS DATE) AS stat_date, count(*) AS behavior_count, count(DISTINCT user_id) AS distinct_user_count, count(DISTINCT behavior_type) AS distinct_behavior_types,
       RATE(count(*), count(DISTINCT user_id), 2) AS avg_behavior_per_user FROM {ods_rf_behavior} GROUP BY ALL"""
SQL["rf_ads_high_value"] = """
SELECT user_id, total_order_amount, order_count, avg_order_amount, last_order_time, :as_of - CAST(last_order_time AS DATE) AS days_since_last_order, data_source
FROM {rf_dws_order_by_user} WHERE total_order_amount >= 5000"""
SQL["rf_ads_risk_warning"] = """
SELECT user_id, refund_count, refund_rate, total_refund_amount,
       CASE WHEN refund_rate >= 50 OR refund_count >= 10 THEN 'high' WHEN refund_rate >= 20 OR refund_count >= 5 THEN 'medium' ELSE 'low' END AS risk_level,
       CASE WHEN refund_rate >= 50 THEN '退款率过高' WHEN refund_count >= 10 THEN '退款次数过多' WHEN total_refund_amount >= 5000 THEN '退款金额过大' ELSE '正常' END AS warning_reason, data_source
FROM {rf_dws_refund_by_user} WHERE refund_rate >= 20 OR refund_count >= 5 OR total_refund_amount >= 5000"""

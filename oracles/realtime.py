"""Real-time statements, over the flat views of the change stream."""

SQL: dict[str, str] = {}

SQL["rt_dwd_comment"] = """
SELECT CAST(c.id AS VARCHAR) AS id, CAST(c.user_id AS VARCHAR) AS user_id, CAST(c.sku_id AS VARCHAR) AS sku_id, c.appraise, md5(c.appraise) AS appraise_key, d.dic_name AS appraise_name,
       c.comment_txt, c.ts_ms FROM {v_cdc_comment_info} c JOIN {ods_base_dic} d ON d.parent_code = '12' AND d.dic_code = c.appraise"""
SQL["rt_dwd_cart_add"] = """
SELECT CAST(id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, CAST(sku_id AS VARCHAR) AS sku_id,
       CASE WHEN op IN ('r', 'c') THEN sku_num ELSE sku_num - before_sku_num END AS sku_num, ts_ms
FROM {v_cdc_cart_info} WHERE op IN ('r', 'c') OR (op = 'u' AND sku_num > before_sku_num)"""
SQL["rt_dwd_order_detail"] = """
SELECT d.id, CAST(d.order_id AS VARCHAR) AS order_id, CAST(o.user_id AS VARCHAR) AS user_id, CAST(d.sku_id AS VARCHAR) AS sku_id, d.sku_name, CAST(o.province_id AS VARCHAR) AS province_id,
       CAST(a.activity_id AS VARCHAR) AS activity_id, CAST(a.activity_rule_id AS VARCHAR) AS activity_rule_id, CAST(c.coupon_id AS VARCHAR) AS coupon_id,
       CAST(make_timestamp(d.create_time * 1000) AS DATE) AS date_id, CAST(d.create_time AS VARCHAR) AS create_time, CAST(d.sku_num AS VARCHAR) AS sku_num,
       CAST(CAST(d.sku_num * d.order_price AS DECIMAL(18,2)) AS VARCHAR) AS split_original_amount, CAST(d.split_activity_amount AS VARCHAR) AS split_activity_amount,
       CAST(d.split_coupon_amount AS VARCHAR) AS split_coupon_amount, CAST(d.split_total_amount AS VARCHAR) AS split_total_amount, d.ts_ms
FROM {v_cdc_order_detail} d JOIN {v_cdc_order_info} o ON o.id = d.order_id AND o.op = 'c'
LEFT JOIN {v_cdc_order_detail_activity} a ON a.order_detail_id = d.id LEFT JOIN {v_cdc_order_detail_coupon} c ON c.order_detail_id = d.id"""
SQL["rt_dwd_order_cancel"] = """
SELECT d.id, d.order_id, d.user_id, d.sku_id, d.sku_name, d.province_id, d.activity_id, d.activity_rule_id, d.coupon_id, left(o.operate_time, 10) AS date_id,
       o.operate_time AS cancel_time, d.sku_num, d.split_original_amount, d.split_activity_amount, d.split_coupon_amount, d.split_total_amount, o.ts_ms
FROM {rt_dwd_order_detail} d JOIN {v_cdc_order_info} o ON CAST(o.id AS VARCHAR) = d.order_id AND o.op = 'u' AND o.before_order_status = '1001' AND o.order_status = '1003'"""
SQL["rt_dwd_pay_suc"] = """
SELECT d.id AS order_detail_id, d.order_id, d.user_id, d.sku_id, d.sku_name, d.province_id, d.activity_id, d.activity_rule_id, d.coupon_id, p.payment_type AS payment_type_code,
       b.dic_name AS payment_type_name, p.callback_time, d.sku_num, d.split_original_amount, d.split_activity_amount, d.split_coupon_amount, d.split_total_amount AS split_payment_amount, p.ts_ms
FROM {rt_dwd_order_detail} d JOIN {v_cdc_payment_info} p ON CAST(p.order_id AS VARCHAR) = d.order_id AND p.payment_status = '1602'
  AND d.ts_ms >= p.ts_ms - 1800000 AND d.ts_ms <= p.ts_ms + 5000
JOIN {ods_base_dic} b ON b.parent_code = '11' AND b.dic_code = p.payment_type"""
SQL["rt_dwd_refund"] = """
SELECT CAST(r.id AS VARCHAR) AS id, CAST(r.user_id AS VARCHAR) AS user_id, CAST(r.order_id AS VARCHAR) AS order_id, CAST(r.sku_id AS VARCHAR) AS sku_id, CAST(o.province_id AS VARCHAR) AS province_id,
       left(r.create_time, 10) AS date_id, r.create_time, r.refund_type AS refund_type_code, a.dic_name AS refund_type_name, r.refund_reason_type AS refund_reason_type_code,
       b.dic_name AS refund_reason_type_name, r.refund_reason_txt, CAST(r.refund_num AS VARCHAR) AS refund_num, CAST(r.refund_amount AS VARCHAR) AS refund_amount, r.ts_ms
FROM {v_cdc_order_refund_info} r JOIN {v_cdc_order_info} o ON o.id = r.order_id AND o.op = 'u' AND o.order_status = '1005'
JOIN {ods_base_dic} a ON a.parent_code = '15' AND a.dic_code = r.refund_type JOIN {ods_base_dic} b ON b.parent_code = '13' AND b.dic_code = r.refund_reason_type WHERE r.op = 'c'"""
SQL["rt_dwd_refund_pay"] = """
SELECT CAST(p.id AS VARCHAR) AS id, CAST(o.user_id AS VARCHAR) AS user_id, CAST(p.order_id AS VARCHAR) AS order_id, CAST(p.sku_id AS VARCHAR) AS sku_id, CAST(o.province_id AS VARCHAR) AS province_id,
       p.payment_type AS payment_type_code, b.dic_name AS payment_type_name, left(p.callback_time, 10) AS date_id, p.callback_time, CAST(r.refund_num AS VARCHAR) AS refund_num,
       CAST(p.total_amount AS VARCHAR) AS refund_amount, p.ts_ms
FROM {v_cdc_refund_payment} p JOIN {v_cdc_order_refund_info} r ON r.order_id = p.order_id AND r.sku_id = p.sku_id AND r.op = 'u' AND r.refund_status = '0705'
JOIN {v_cdc_order_info} o ON o.id = p.order_id AND o.op = 'u' AND o.order_status = '1006' JOIN {ods_base_dic} b ON b.parent_code = '11' AND b.dic_code = p.payment_type
WHERE p.op = 'u' AND p.refund_status = '1602'"""
_DAY = "CAST(make_timestamp(ts_ms * 1000) AS DATE)"
SQL["rt_dws_interaction_user"] = f"""
SELECT user_id, date_id, coalesce(cart_add_count, 0) AS cart_add_count, coalesce(cart_add_num, 0) AS cart_add_num, coalesce(comment_count, 0) AS comment_count,
       coalesce(good_comment_count, 0) AS good_comment_count
FROM (SELECT user_id, {_DAY} AS date_id, count(*) AS cart_add_count, sum(sku_num) AS cart_add_num FROM {{rt_dwd_cart_add}} GROUP BY ALL)
FULL JOIN (SELECT user_id, {_DAY} AS date_id, count(*) AS comment_count, count(*) FILTER (WHERE appraise = '1201') AS good_comment_count FROM {{rt_dwd_comment}} GROUP BY ALL)
  USING (user_id, date_id)"""
_AMOUNTS = ", ".join(
    f"sum(CAST({c} AS DECIMAL(16,2))) AS {n}" for n, c in [
        ("order_original_amount", "split_original_amount"), ("order_total_amount", "split_total_amount"),
        ("order_activity_amount", "split_activity_amount"), ("order_coupon_amount", "split_coupon_amount")]
)
_ORDERS = f"count(DISTINCT order_id) AS order_count, sum(CAST(sku_num AS BIGINT)) AS order_num, {_AMOUNTS}"
SQL["rt_dws_province"] = f"SELECT province_id, date_id, {_ORDERS} FROM {{rt_dwd_order_detail}} GROUP BY province_id, date_id"
SQL["rt_dws_user_goods"] = f"""
SELECT o.*, CASE WHEN c.user_id IS NOT NULL THEN c.n END AS cart_add_count, c.num AS cart_add_num, m.n AS comment_count, m.good AS good_comment_count
FROM (SELECT user_id, sku_id, date_id, {_ORDERS} FROM {{rt_dwd_order_detail}} GROUP BY user_id, sku_id, date_id) o
LEFT JOIN (SELECT user_id, sku_id, count(*) AS n, sum(sku_num) AS num FROM {{rt_dwd_cart_add}} GROUP BY ALL) c USING (user_id, sku_id)
LEFT JOIN (SELECT user_id, sku_id, count(*) AS n, count(*) FILTER (WHERE appraise = '1201') AS good FROM {{rt_dwd_comment}} GROUP BY ALL) m USING (user_id, sku_id)"""


def _cells(table, source, keys, measures):
    key = " || '|' || ".join(k if k != "date_id" else "strftime(date_id, '%Y-%m-%d')" for k in keys)
    return [f"SELECT '{table}' AS target_table, {key} AS row_key, '{m}' AS measure, CAST({m} AS DECIMAL(28,2)) AS value FROM {{{source}}} WHERE {m} IS NOT NULL" for m in measures]


_U = ["cart_add_count", "cart_add_num", "comment_count", "good_comment_count"]
_O = ["order_count", "order_num", "order_original_amount", "order_total_amount", "order_activity_amount", "order_coupon_amount"]
SQL["rt_sync_mysql"] = " UNION ALL ".join(
    _cells("dws_interaction_user_stats", "rt_dws_interaction_user", ["user_id", "date_id"], _U)
    + _cells("dws_trade_province_stats", "rt_dws_province", ["province_id", "date_id"], _O)
    + _cells("dws_user_goods_stats", "rt_dws_user_goods", ["user_id", "sku_id", "date_id"], _O + _U)
)
SQL["rt_cdc_to_dim"] = " UNION ALL ".join(
    [f"SELECT 'dim_comment' AS sink_table, md5(CAST(id AS VARCHAR)) AS row_key, '{c}' AS column_name, CAST({c} AS VARCHAR) AS column_value FROM {{v_cdc_comment_info}}" for c in ("id", "user_id", "appraise")]
    + [f"SELECT 'dim_order_state', md5(CAST(id AS VARCHAR)), '{c}', CAST(arg_max({c}, (ts_ms, op)) AS VARCHAR) FROM {{v_cdc_order_info}} GROUP BY id" for c in ("id", "order_status")]
)
_T = ("order_info order_detail order_detail_activity order_detail_coupon payment_info order_refund_info refund_payment cart_info comment_info").split()
SQL["rf_cdc_to_lake"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, pk_ AS pk, op_ AS op, ts_ AS ts_ms, name AS \"column\", value FROM "
    "(SELECT CAST(id AS VARCHAR) AS pk_, op AS op_, ts_ms AS ts_, CAST(COLUMNS(lambda c: c NOT IN ('op', 'ts_ms') AND c NOT LIKE 'before%') AS VARCHAR) "
    f"FROM (SELECT * FROM {{v_cdc_{t}}} QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, op DESC) = 1)) "
    "UNPIVOT INCLUDE NULLS (value FOR name IN (COLUMNS(* EXCLUDE (pk_, op_, ts_))))" for t in _T
)

# the split log, with every event's text spelled out; a block's fields come in order of their names
_COMMON = (
    """'{"ar":"' || ar || '","ba":"' || ba || '","ch":"' || ch || '","md":"' || md || '","mid":"' || mid || '","os":"' || os || '"' """
    """|| ',"sid":"' || sid || '"' || coalesce(',"uid":"' || uid || '"', '') || ',"vc":"' || vc || '","is_new":"' || fixed || '"}'"""
)
_PAGE = (
    """'{"during_time":' || during_time || ',"from_pos_id":"' || from_pos_id || '","from_pos_seq":"' || from_pos_seq || '","item":"' || item || '","item_type":"sku_id"' """
    """|| coalesce(',"last_page_id":"' || last_page_id || '"', '') || ',"page_id":"' || page_id || '","refer_id":"' || refer_id || '"}'"""
)
SQL["v_log_fixed"] = f"""
SELECT *, {_COMMON} AS common, {_PAGE} AS page FROM (
  SELECT l.*, CASE WHEN l.is_new = '1' AND CAST(make_timestamp(l.ts_ms * 1000) + INTERVAL 8 HOUR AS DATE) <> f.first_day THEN '0' ELSE l.is_new END AS fixed
  FROM {{v_log}} l JOIN (
    SELECT mid, CAST(make_timestamp(min(ts_ms) * 1000) + INTERVAL 8 HOUR AS DATE) - CASE WHEN arg_min(is_new, (ts_ms, is_new <> '1')) = '1' THEN 0 ELSE 1 END AS first_day
    FROM {{v_log}} WHERE NOT (event_type = 'error' AND k % 10 = 7) GROUP BY mid) f USING (mid)
  WHERE NOT (l.event_type = 'error' AND l.k % 10 = 7))"""
_TAIL = """',"ts":' || ts_ms || '}'"""
SQL["rt_log_split"] = f"""
SELECT 'dirty' AS route, '{{broken' AS value, CAST(NULL AS BIGINT) AS ts, CAST(NULL AS VARCHAR) AS mid, CAST(NULL AS VARCHAR) AS is_new FROM {{v_log}} WHERE event_type = 'error' AND k % 10 = 7
UNION ALL SELECT 'err', '{{"err":{{"error_code":1000,"msg":"failed"}},"common":' || common || {_TAIL}, ts_ms, mid, fixed FROM {{v_log_fixed}} WHERE event_type = 'error'
UNION ALL SELECT 'start', '{{"common":' || common || ',"start":{{"entry":"icon","loading_time":' || during_time || '}}' || {_TAIL}, ts_ms, mid, fixed FROM {{v_log_fixed}} WHERE event_type = 'error' AND k % 2 = 0
UNION ALL SELECT 'page', '{{"common":' || common || coalesce(',"page":' || page, '') || {_TAIL}, ts_ms, mid, fixed FROM {{v_log_fixed}} WHERE event_type <> 'error' OR k % 2 = 1
UNION ALL SELECT 'display', '{{"common":' || common || ',"page":' || page || ',"display":{{"item":"d' || i || '","pos_seq":' || i || '}}' || {_TAIL}, ts_ms, mid, fixed
  FROM (SELECT *, unnest(generate_series(1, k % 3 + 1)) AS i FROM {{v_log_fixed}} WHERE event_type = 'view')
UNION ALL SELECT 'action', '{{"common":' || common || ',"page":' || page || ',"action":{{"action_id":"cart_add","item":"' || item || '"}}' || {_TAIL}, ts_ms, mid, fixed FROM {{v_log_fixed}} WHERE event_type = 'click'"""

"""Shop statements."""

from oracles.patterns import EMAIL, MOBILE

SQL: dict[str, str] = {}

SQL["dim_activity"] = """
SELECT r.id AS activity_rule_id, r.activity_id, i.activity_name, r.activity_type AS activity_type_code, d.dic_name AS activity_type_name,
       i.activity_desc, i.start_time, i.end_time, i.create_time, r.condition_amount, r.condition_num, r.benefit_amount, r.benefit_discount,
       CASE r.activity_type WHEN '3101' THEN '满' || r.condition_amount || '元减' || r.benefit_amount || '元'
            WHEN '3102' THEN '满' || r.condition_num || '件打' || r.benefit_discount || ' 折'
            WHEN '3103' THEN '打' || r.benefit_discount || '折' END AS benefit_rule, r.benefit_level
FROM {ods_activity_rule} r LEFT JOIN {ods_activity_info} i ON r.activity_id = i.id
LEFT JOIN {ods_base_dic} d ON d.parent_code = '31' AND d.dic_code = r.activity_type"""
SQL["dim_coupon"] = """
SELECT c.id, c.coupon_name, c.coupon_type AS coupon_type_code, t.dic_name AS coupon_type_name, c.condition_amount, c.condition_num, c.activity_id,
       c.benefit_amount, c.benefit_discount,
       CASE c.coupon_type WHEN '3201' THEN '满' || c.condition_amount || '元减' || c.benefit_amount || '元'
            WHEN '3202' THEN '满' || c.condition_num || '件打' || c.benefit_discount || ' 折'
            WHEN '3203' THEN '减' || c.benefit_amount || '元' END AS benefit_rule,
       c.create_time, c.range_type AS range_type_code, r.dic_name AS range_type_name, c.limit_num, c.taken_count, c.start_time, c.end_time,
       c.operate_time, c.expire_time
FROM {ods_coupon_info} c LEFT JOIN {ods_base_dic} t ON t.parent_code = '32' AND t.dic_code = c.coupon_type
LEFT JOIN {ods_base_dic} r ON r.parent_code = '33' AND r.dic_code = c.range_type"""
SQL["dim_date"] = """
SELECT d AS date_id, weekofyear(d) AS week_id, isodow(d) AS week_day, day(d) AS day, month(d) AS month, quarter(d) AS quarter, year(d) AS year,
       isodow(d) < 6 AS is_workday
FROM (SELECT CAST(unnest(generate_series(CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d FROM {lineitem})"""
SQL["dim_promotion_pos"] = "SELECT id, pos_type, promotion_type, create_time, operate_time FROM {ods_promotion_pos}"
SQL["dim_promotion_refer"] = "SELECT id, refer_name, create_time, operate_time FROM {ods_promotion_refer}"
SQL["dim_province"] = """
SELECT p.id, p.name AS province_name, p.area_code, p.iso_code, p.iso_3166_2, p.region_id, r.region_name
FROM {ods_base_province} p LEFT JOIN {ods_base_region} r ON p.region_id = r.id"""
SQL["dim_sku"] = """
SELECT s.id, s.price, s.sku_name, s.sku_desc, s.weight, s.is_sale = '1' AS is_sale, s.spu_id, p.spu_name, s.category3_id, c3.name AS category3_name,
       c3.category2_id, c2.name AS category2_name, c2.category1_id, c1.name AS category1_name, s.tm_id, t.tm_name,
       (SELECT string_agg(DISTINCT a.attr_id || ':' || a.value_id || ':' || a.attr_name || ':' || a.value_name, ',' ORDER BY a.attr_id || ':' || a.value_id || ':' || a.attr_name || ':' || a.value_name)
        FROM {ods_sku_attr_value} a WHERE a.sku_id = s.id) AS sku_attr_values,
       (SELECT string_agg(DISTINCT a.sale_attr_id || ':' || a.sale_attr_value_id || ':' || a.sale_attr_name || ':' || a.sale_attr_value_name, ',')
        FROM {ods_sku_sale_attr_value} a WHERE a.sku_id = s.id) AS sku_sale_attr_values, s.create_time
FROM {ods_sku_info} s LEFT JOIN {ods_spu_info} p ON p.id = s.spu_id LEFT JOIN {ods_base_category3} c3 ON c3.id = s.category3_id
LEFT JOIN {ods_base_category2} c2 ON c2.id = c3.category2_id LEFT JOIN {ods_base_category1} c1 ON c1.id = c2.category1_id
LEFT JOIN {ods_base_trademark} t ON t.id = s.tm_id"""
SQL["dim_user_zip"] = f"""
SELECT id, left(name, 1) || '*' AS name, CASE WHEN regexp_matches(phone_num, '{MOBILE}') THEN left(phone_num, 3) || '*' END AS phone_num,
       CASE WHEN regexp_matches(email, '{EMAIL}') THEN '*@' || split_part(email, '@', 2) END AS email, user_level,
       DATE '1970-01-01' + birthday AS birthday, gender, create_time, operate_time, '2024-01-30' AS start_date, '9999-12-31' AS end_date
FROM {{ods_user_info}}"""

SQL["dwd_order_detail"] = """
SELECT d.id, d.order_id, o.user_id, d.sku_id, o.province_id, a.activity_id, a.activity_rule_id, c.coupon_id, CAST(d.create_time AS DATE) AS date_id,
       d.create_time, d.sku_num, CAST(d.order_price * d.sku_num AS DECIMAL(18,2)) AS split_original_amount,
       CAST(coalesce(d.split_activity_amount, 0) AS DECIMAL(18,2)) AS split_activity_amount, CAST(coalesce(d.split_coupon_amount, 0) AS DECIMAL(18,2)) AS split_coupon_amount,
       CAST(d.split_total_amount AS DECIMAL(18,2)) AS split_total_amount, CAST(d.create_time AS DATE) AS dt
FROM {ods_order_detail} d LEFT JOIN {ods_order_info} o ON o.id = d.order_id LEFT JOIN {ods_order_detail_activity} a ON a.order_detail_id = d.id
LEFT JOIN {ods_order_detail_coupon} c ON c.order_detail_id = d.id"""
SQL["dwd_pay_suc_detail"] = """
SELECT d.id, d.order_id, p.user_id, d.sku_id, o.province_id, a.activity_id, a.activity_rule_id, c.coupon_id, p.payment_type AS payment_type_code,
       b.dic_name AS payment_type_name, CAST(p.callback_time AS DATE) AS date_id, p.callback_time, d.sku_num,
       CAST(d.order_price * d.sku_num AS DECIMAL(18,2)) AS split_original_amount,
       CAST(coalesce(d.split_activity_amount, 0) AS DECIMAL(18,2)) AS split_activity_amount, CAST(coalesce(d.split_coupon_amount, 0) AS DECIMAL(18,2)) AS split_coupon_amount,
       CAST(d.split_total_amount AS DECIMAL(18,2)) AS split_payment_amount, CAST(p.callback_time AS DATE) AS dt
FROM {ods_order_detail} d JOIN {ods_payment_info} p ON p.order_id = d.order_id LEFT JOIN {ods_order_info} o ON o.id = d.order_id
LEFT JOIN {ods_order_detail_activity} a ON a.order_detail_id = d.id LEFT JOIN {ods_order_detail_coupon} c ON c.order_detail_id = d.id
LEFT JOIN {ods_base_dic} b ON b.parent_code = '11' AND b.dic_code = p.payment_type"""
SQL["dwd_trade_flow_acc"] = """
SELECT o.id AS order_id, o.user_id, o.province_id, CAST(o.create_time AS DATE) AS order_date_id, o.create_time AS order_time,
       CAST(p.callback_time AS DATE) AS payment_date_id, p.callback_time AS payment_time, CAST(l.operate_time AS DATE) AS finish_date_id,
       l.operate_time AS finish_time, o.original_total_amount AS order_original_amount, o.activity_reduce_amount AS order_activity_amount,
       o.coupon_reduce_amount AS order_coupon_amount, o.total_amount AS order_total_amount, CAST(coalesce(p.total_amount, 0) AS DECIMAL(16,2)) AS payment_amount
FROM {ods_order_info} o LEFT JOIN {ods_payment_info} p ON p.order_id = o.id LEFT JOIN {ods_order_status_log} l ON l.order_id = o.id AND l.order_status = '1004'"""
SQL["dwd_cart_add"] = """
SELECT id, user_id, sku_id, CAST(create_time AS DATE) AS date_id, create_time, sku_num, CAST(create_time AS DATE) AS dt FROM {ods_cart_info}"""
SQL["dwd_cart_full"] = "SELECT id, user_id, sku_id, sku_name, sku_num FROM {ods_cart_info} WHERE is_ordered = '0'"
SQL["dwd_coupon_used"] = """
SELECT id, coupon_id, user_id, order_id, CAST(used_time AS DATE) AS date_id, CAST(used_time AS DATE) AS dt FROM {ods_coupon_use}"""
SQL["dwd_favor_add"] = """
SELECT id, user_id, sku_id, CAST(create_time AS DATE) AS date_id, create_time, CAST(create_time AS DATE) AS dt FROM {ods_favor_info}"""
SQL["dwd_page_view"] = """
SELECT CAST(ar AS VARCHAR) AS province_id, ba AS brand, ch AS channel, is_new, md AS model, mid AS mid_id, os AS operate_system, CAST(uid AS VARCHAR) AS user_id,
       vc AS version_code, item AS page_item, item_type AS page_item_type, last_page_id, page_id, from_pos_id, from_pos_seq, refer_id,
       CAST(ts + INTERVAL 8 HOUR AS DATE) AS date_id, epoch_ms(ts_ms) + INTERVAL 8 HOUR AS view_time, sid AS session_id, during_time, ts_ms AS ts,
       CAST(ts + INTERVAL 8 HOUR AS DATE) AS dt
FROM {v_log} WHERE page_id IS NOT NULL"""
SQL["dwd_user_login"] = """
SELECT session_id, user_id, date_id, view_time AS login_time, channel, province_id, version_code, mid_id, brand, model, operate_system, dt
FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts, page_item, page_id) AS rn FROM {dwd_page_view} WHERE user_id IS NOT NULL) WHERE rn = 1"""
SQL["dwd_user_register"] = """
SELECT CAST(u.id AS VARCHAR) AS user_id, CAST(u.create_time AS DATE) AS date_id, u.create_time, l.channel, l.province_id, l.version_code, l.mid_id, l.brand, l.model, l.operate_system
FROM {ods_user_info} u LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, page_item) AS rn FROM {dwd_page_view} WHERE page_id = 'register' AND user_id IS NOT NULL
) l ON l.rn = 1 AND l.user_id = CAST(u.id AS VARCHAR)"""

_AMOUNTS = """sum(split_original_amount) AS order_original_amount_1d, sum(split_activity_amount) AS activity_reduce_amount_1d,
       sum(split_coupon_amount) AS coupon_reduce_amount_1d, sum(split_total_amount) AS order_total_amount_1d"""
_SKU = "sku_name, category1_id, category1_name, category2_id, category2_name, category3_id, category3_name, tm_id, tm_name"
_PLACE = "province_name, area_code, iso_code, iso_3166_2"
SQL["dws_province_order_1d"] = f"""
SELECT o.*, {_PLACE} FROM (
  SELECT province_id, dt, count(DISTINCT order_id) AS order_count_1d, {_AMOUNTS} FROM {{dwd_order_detail}} GROUP BY province_id, dt
) o LEFT JOIN {{dim_province}} p ON p.id = o.province_id"""


def _nd(measures):
    out = []
    for n in (7, 30):
        for m in measures:
            out.append(f"sum(CASE WHEN dt > :as_of - {n} THEN {m}_1d ELSE 0 END) AS {m}_{n}d")
    return ", ".join(out)


_M = ["order_original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_total_amount"]
SQL["dws_province_order_nd"] = f"""
SELECT province_id, {_PLACE}, {_nd(["order_count", *_M])} FROM {{dws_province_order_1d}} WHERE dt > :as_of - 30 AND dt <= :as_of GROUP BY ALL"""
SQL["dws_sku_favor_1d"] = f"""
SELECT f.*, {_SKU} FROM (SELECT sku_id, dt, count(*) AS favor_add_count_1d FROM {{dwd_favor_add}} GROUP BY ALL) f LEFT JOIN {{dim_sku}} s ON s.id = f.sku_id"""
SQL["dws_coupon_used_1d"] = """
SELECT u.*, c.coupon_name, c.coupon_type_code, c.coupon_type_name, c.benefit_rule
FROM (SELECT user_id, coupon_id, dt, count(*) AS used_count_1d FROM {dwd_coupon_used} GROUP BY ALL) u LEFT JOIN {dim_coupon} c ON c.id = u.coupon_id"""
SQL["dws_user_cart_1d"] = "SELECT user_id, dt, count(*) AS cart_add_count_1d, sum(sku_num) AS cart_add_num_1d FROM {dwd_cart_add} GROUP BY ALL"
SQL["dws_user_order_1d"] = f"""
SELECT user_id, dt, count(DISTINCT order_id) AS order_count_1d, sum(sku_num) AS order_num_1d, {_AMOUNTS} FROM {{dwd_order_detail}} GROUP BY user_id, dt"""
SQL["dws_user_order_td"] = """
SELECT user_id, min(dt) AS order_date_first, max(dt) AS order_date_last, sum(order_count_1d) AS order_count_td, sum(order_num_1d) AS order_num_td,
       sum(order_original_amount_1d) AS original_amount_td, sum(activity_reduce_amount_1d) AS activity_reduce_amount_td,
       sum(coupon_reduce_amount_1d) AS coupon_reduce_amount_td, sum(order_total_amount_1d) AS total_amount_td FROM {dws_user_order_1d} WHERE dt <= :as_of GROUP BY user_id"""
SQL["dws_user_payment_1d"] = """
SELECT user_id, dt, count(DISTINCT order_id) AS payment_count_1d, sum(sku_num) AS payment_num_1d, sum(split_payment_amount) AS payment_amount_1d
FROM {dwd_pay_suc_detail} GROUP BY user_id, dt"""
SQL["dws_user_sku_order_1d"] = f"""
SELECT o.*, {_SKU} FROM (
  SELECT user_id, sku_id, dt, count(*) AS order_count_1d, sum(sku_num) AS order_num_1d, {_AMOUNTS} FROM {{dwd_order_detail}} GROUP BY user_id, sku_id, dt
) o LEFT JOIN {{dim_sku}} s ON s.id = o.sku_id"""
SQL["dws_user_sku_order_nd"] = f"""
SELECT user_id, sku_id, {_SKU}, {_nd(["order_count", "order_num", *_M])} FROM {{dws_user_sku_order_1d}} WHERE dt > :as_of - 30 AND dt <= :as_of GROUP BY ALL"""
SQL["dws_page_visitor_1d"] = """
SELECT mid_id, brand, model, operate_system, page_id, dt, sum(during_time) AS during_time_1d, count(*) AS view_count_1d FROM {dwd_page_view} GROUP BY ALL"""
SQL["dws_session_page_view_1d"] = """
SELECT session_id, mid_id, brand, model, operate_system, version_code, channel, dt, sum(during_time) AS during_time_1d, count(*) AS page_count_1d
FROM {dwd_page_view} GROUP BY ALL"""
_LOGIN = """
SELECT CAST(u.id AS VARCHAR) AS user_id, coalesce(l.last_dt, CAST(u.create_time AS DATE)) AS login_date_last, CAST(u.create_time AS DATE) AS login_date_first,
       coalesce(l.n, 1) AS login_count_td
FROM {{ods_user_info}} u LEFT JOIN (SELECT user_id, max(dt) AS last_dt, count(*) AS n FROM {{dwd_user_login}} WHERE dt <= :log_as_of - {d} GROUP BY user_id) l
  ON l.user_id = CAST(u.id AS VARCHAR) WHERE CAST(u.create_time AS DATE) <= :log_as_of - {d}"""
SQL["dws_user_login_td"] = _LOGIN.format(d=0)
SQL["dws_user_login_td_previous"] = _LOGIN.format(d=1)

SQL["ads_coupon_stats"] = """
SELECT dt, coupon_id, coupon_name, sum(used_count_1d) AS used_count, count(*) AS used_user_count FROM {dws_coupon_used_1d} GROUP BY ALL"""
_W = "(VALUES (1), (7), (30)) w(recent_days)"
SQL["ads_new_order_user"] = f"""
SELECT :as_of AS dt, recent_days, count(*) AS new_order_user_count FROM {{dws_user_order_td}}, {_W}
WHERE order_date_first > :as_of - recent_days AND order_date_first <= :as_of GROUP BY recent_days"""
SQL["ads_order_by_province"] = f"""
SELECT :as_of AS dt, 1 AS recent_days, province_id, {_PLACE}, order_count_1d AS order_count, order_total_amount_1d AS order_total_amount FROM {{dws_province_order_1d}} WHERE dt = :as_of
UNION SELECT :as_of, 7, province_id, {_PLACE}, order_count_7d, order_total_amount_7d FROM {{dws_province_order_nd}}
UNION SELECT :as_of, 30, province_id, {_PLACE}, order_count_30d, order_total_amount_30d FROM {{dws_province_order_nd}}"""
_RUN = "SELECT :as_of AS dt, 7 AS recent_days, count(DISTINCT user_id) AS order_continuously_user_count FROM "
_DAYS = "(SELECT DISTINCT user_id, dt FROM {dws_user_order_1d} WHERE dt >= :as_of - 6 AND dt <= :as_of)"
# by self-join: some day has its two successors
_THREE = _RUN + f"{_DAYS} a JOIN {_DAYS} b USING (user_id) JOIN {_DAYS} c USING (user_id) WHERE b.dt = a.dt + 1 AND c.dt = a.dt + 2"
for _name in ("ads_continuous_order", "ads_continuous_order_islands", "ads_continuous_order_bitmap"):
    SQL[_name] = _THREE
SQL["ads_continuous_order_gap"] = _RUN + (
    f"{_DAYS} a JOIN {_DAYS} b USING (user_id) JOIN {_DAYS} c USING (user_id) WHERE b.dt > a.dt AND c.dt > b.dt AND c.dt <= a.dt + 3"
)


def _buyers(keys):
    return f"""
SELECT :as_of AS dt, w.recent_days, {keys}, sum(order_count_1d) AS order_count, count(DISTINCT user_id) AS order_user_count
FROM {{dws_user_sku_order_1d}}, {_W} WHERE dt > :as_of - w.recent_days AND dt <= :as_of GROUP BY ALL
UNION ALL
SELECT :as_of, 7, {keys}, 0, 0 FROM {{dws_user_sku_order_1d}} WHERE dt > :as_of - 30 AND dt <= :as_of
GROUP BY ALL HAVING count(*) FILTER (WHERE dt > :as_of - 7) = 0"""


SQL["ads_order_by_cate"] = _buyers("category1_id, category1_name, category2_id, category2_name, category3_id, category3_name")
SQL["ads_order_by_brand"] = _buyers("tm_id, tm_name")
SQL["ads_order_to_pay_avg"] = """
SELECT :as_of AS dt, CAST(floor(avg(epoch(payment_time) - epoch(order_time))) AS BIGINT) AS order_to_pay_interval_avg
FROM {dwd_trade_flow_acc} WHERE payment_date_id = :as_of"""
SQL["ads_page_path"] = """
SELECT dt, 'step-' || rn || ':' || page_id AS source, coalesce('step-' || (rn + 1) || ':' || next_page, 'null') AS target, count(*) AS path_count
FROM (SELECT dt, page_id, row_number() OVER w AS rn, lead(page_id) OVER w AS next_page FROM {dwd_page_view}
      WINDOW w AS (PARTITION BY session_id, dt ORDER BY ts, page_item)) GROUP BY ALL"""
SQL["ads_repeat_purchase"] = """
SELECT :as_of AS dt, 30 AS recent_days, tm_id, tm_name,
       RATE(count(*) FILTER (WHERE n >= 2), nullif(count(*) FILTER (WHERE n >= 1), 0), 4) AS order_repeat_rate
FROM (SELECT tm_id, tm_name, user_id, sum(order_count_30d) AS n FROM {dws_user_sku_order_nd} GROUP BY ALL) GROUP BY tm_id, tm_name"""
SQL["ads_cart_top3_by_cate"] = """
SELECT :log_as_of AS dt, category1_id, category1_name, category2_id, category2_name, category3_id, category3_name, sku_id, sku_name, cart_num, rk FROM (
  SELECT c.*, s.* EXCLUDE (id), rank() OVER (PARTITION BY category1_id, category2_id, category3_id ORDER BY cart_num DESC) AS rk
  FROM (SELECT sku_id, sum(sku_num) AS cart_num FROM {dwd_cart_full} GROUP BY sku_id) c LEFT JOIN {dim_sku} s ON s.id = c.sku_id) WHERE rk <= 3"""
SQL["ads_favor_top3_by_brand"] = """
SELECT dt, tm_id, tm_name, sku_id, sku_name, favor_add_count_1d, rk FROM (
  SELECT *, rank() OVER (PARTITION BY dt, tm_id ORDER BY favor_add_count_1d DESC) AS rk FROM {dws_sku_favor_1d}) WHERE rk <= 3"""
SQL["ads_traffic_by_channel"] = f"""
SELECT :log_as_of AS dt, recent_days, channel, count(DISTINCT mid_id) AS uv_count, CAST(floor(avg(during_time_1d) / 1000) AS BIGINT) AS avg_duration_sec,
       CAST(floor(avg(page_count_1d)) AS BIGINT) AS avg_page_count, count(*) AS sv_count,
       RATE(count(*) FILTER (WHERE page_count_1d = 1), count(*), 4) AS bounce_rate
FROM {{dws_session_page_view_1d}}, {_W} WHERE dt > :log_as_of - recent_days AND dt <= :log_as_of GROUP BY ALL"""
SQL["ads_user_action"] = """
SELECT :log_as_of AS dt, (SELECT count(*) FROM {dws_page_visitor_1d} WHERE dt = :log_as_of AND page_id = 'home') AS home_count,
       (SELECT count(*) FROM {dws_page_visitor_1d} WHERE dt = :log_as_of AND page_id = 'good_detail') AS good_detail_count,
       (SELECT count(*) FROM {dws_user_cart_1d} WHERE dt = :log_as_of) AS cart_count,
       (SELECT count(*) FROM {dws_user_order_1d} WHERE dt = :as_of) AS order_count,
       (SELECT count(*) FROM {dws_user_payment_1d} WHERE dt = :as_of) AS payment_count"""
SQL["ads_user_change"] = """
SELECT :log_as_of AS dt, (SELECT count(*) FROM {dws_user_login_td} WHERE login_date_last = :log_as_of - 7) AS user_churn_count,
       (SELECT count(*) FROM {dws_user_login_td} a JOIN {dws_user_login_td_previous} b USING (user_id)
        WHERE a.login_date_last = :log_as_of AND a.login_date_last - b.login_date_last >= 8) AS user_back_count"""
SQL["ads_user_retention"] = """
SELECT :log_as_of AS dt, login_date_first AS create_date, :log_as_of - login_date_first AS retention_day,
       count(*) FILTER (WHERE login_date_last = :log_as_of) AS retention_count, count(*) AS new_user_count,
       RATE(100 * count(*) FILTER (WHERE login_date_last = :log_as_of), count(*), 2) AS retention_rate
FROM {dws_user_login_td} WHERE login_date_first >= :log_as_of - 7 AND login_date_first < :log_as_of GROUP BY login_date_first"""
SQL["ads_user_stats"] = f"""
SELECT :log_as_of AS dt, recent_days, count(*) FILTER (WHERE login_date_first > :log_as_of - recent_days) AS new_user_count, count(*) AS active_user_count
FROM {{dws_user_login_td}}, {_W} WHERE login_date_last > :log_as_of - recent_days GROUP BY recent_days"""

"""Logistics statements."""

from oracles.patterns import EMAIL, MOBILE

SQL: dict[str, str] = {}

SQL["dim_complex"] = """
SELECT c.id, c.complex_name, (SELECT string_agg(DISTINCT CAST(k.courier_emp_id AS VARCHAR), ',' ORDER BY CAST(k.courier_emp_id AS VARCHAR))
        FROM {ods_tms_courier_complex} k WHERE k.complex_id = c.id AND k.is_deleted = '0') AS courier_emp_ids,
       c.province_id, p.name AS province_name, c.city_id, t.name AS city_name, c.district_id, c.district_name
FROM {ods_tms_complex} c JOIN {ods_tms_region} p ON p.id = c.province_id AND p.is_deleted = '0' JOIN {ods_tms_region} t ON t.id = c.city_id AND t.is_deleted = '0'
WHERE c.is_deleted = '0'"""
SQL["dim_organ"] = """
SELECT o.id, o.org_name, o.org_level, o.region_id, r.name AS region_name, r.dict_code AS region_code, o.org_parent_id, p.org_name AS org_parent_name
FROM {ods_tms_organ} o LEFT JOIN {ods_tms_region} r ON r.id = o.region_id AND r.is_deleted = '0' LEFT JOIN {ods_tms_organ} p ON p.id = o.org_parent_id AND p.is_deleted = '0'
WHERE o.is_deleted = '0'"""
SQL["dim_region"] = "SELECT id, parent_id, name, dict_code, short_name FROM {ods_tms_region} WHERE is_deleted = '0'"
SQL["dim_express_courier"] = """
SELECT c.id, c.emp_id, c.org_id, o.org_name, md5(c.working_phone) AS working_phone, c.express_type, d.name AS express_type_name
FROM {ods_tms_courier} c JOIN {ods_tms_organ} o ON o.id = c.org_id JOIN {ods_tms_dic} d ON d.id = CAST(c.express_type AS BIGINT)"""
SQL["dim_shift"] = """
SELECT s.id, s.line_id, l.name AS line_name, l.line_no, l.line_level, l.org_id, l.transport_line_type_id, d.name AS transport_line_type_name, l.start_org_id,
       l.start_org_name, l.end_org_id, l.end_org_name, l.pair_line_id, l.distance, l.cost, l.estimated_time, s.start_time, s.driver1_emp_id, s.driver2_emp_id, s.truck_id, s.pair_shift_id
FROM {ods_tms_shift} s JOIN {ods_tms_line} l ON l.id = s.line_id JOIN {ods_tms_dic} d ON d.id = CAST(l.transport_line_type_id AS BIGINT)"""
SQL["dim_truck_driver"] = """
SELECT d.id, d.emp_id, d.org_id, o.org_name, d.team_id, t.name AS team_name, d.license_type, d.init_license_date, d.expire_date, d.license_no, d.is_enabled
FROM {ods_tms_driver} d JOIN {ods_tms_organ} o ON o.id = d.org_id JOIN {ods_tms_team} t ON t.id = d.team_id"""
SQL["dim_truck"] = """
SELECT k.id, k.team_id, t.name AS team_name, t.team_no, t.org_id, o.org_name, t.manager_emp_id, md5(k.truck_no) AS truck_no, k.truck_model_id, m.model_name AS truck_model_name,
       m.model_type AS truck_model_type, a.name AS truck_model_type_name, m.model_no AS truck_model_no, m.brand AS truck_brand, b.name AS truck_brand_name, m.truck_weight,
       m.load_weight, m.total_weight, m.eev, m.boxcar_len, m.boxcar_wd, m.boxcar_hg, m.max_speed, m.oil_vol, k.device_gps_id, k.engine_no, k.license_registration_date,
       k.license_last_check_date, k.license_expire_date, k.is_enabled
FROM {ods_tms_truck} k JOIN {ods_tms_team} t ON t.id = k.team_id JOIN {ods_tms_model} m ON m.id = k.truck_model_id JOIN {ods_tms_organ} o ON o.id = t.org_id
JOIN {ods_tms_dic} a ON a.id = CAST(m.model_type AS BIGINT) JOIN {ods_tms_dic} b ON b.id = CAST(m.brand AS BIGINT) WHERE k.is_deleted = '0'"""
SQL["dim_user_zip_tms"] = f"""
SELECT id, login_name, nick_name, md5(passwd) AS passwd, md5(real_name) AS realname, CASE WHEN regexp_matches(phone_num, '{MOBILE}') THEN md5(phone_num) END AS phone_num,
       CASE WHEN regexp_matches(email, '{EMAIL}') THEN md5(email) END AS email, user_level, DATE '1970-01-01' + birthday AS birthday, gender,
       strftime(make_timestamp(create_time * 1000), '%Y-%m-%d') AS start_date, '9999-12-31' AS end_date FROM {{ods_tms_user}} WHERE is_deleted = '0'"""
SQL["dim_user_address_zip"] = f"""
SELECT id, user_id, CASE WHEN regexp_matches(phone, '{MOBILE}') THEN md5(phone) END AS phone, province_id, city_id, district_id, complex_id, address, is_default,
       replace(left(create_time, 19), 'T', ' ') AS start_date, '9999-12-31' AS end_date FROM {{ods_tms_address}}"""

_SIDES = """o.user_id, o.receiver_complex_id, o.receiver_province_id, o.receiver_city_id, o.receiver_district_id, left(o.receiver_name, 1) || '*' AS receiver_name,
       o.sender_complex_id, o.sender_province_id, o.sender_city_id, o.sender_district_id, left(o.sender_name, 1) || '*' AS sender_name"""
_HEAD = f"""c.id, c.order_id, c.cargo_type, dc.name AS cargo_type_name, c.volume_length, c.volume_width, c.volume_height, c.weight, o.order_no, o.status, ds.name AS status_name,
       o.collect_type, dl.name AS collect_type_name, {_SIDES}, o.cargo_num, o.amount,
       strftime(make_timestamp(o.estimate_arrive_time * 1000), '%Y-%m-%d %H:%M:%S') AS estimate_arrive_time, o.distance"""
_FROM = """FROM (SELECT * FROM {ods_tms_cargo} WHERE is_deleted = '0') c JOIN (SELECT * FROM {ods_tms_order} WHERE is_deleted = '0') o ON o.id = c.order_id
LEFT JOIN {ods_tms_dic} dc ON dc.id = CAST(c.cargo_type AS BIGINT) LEFT JOIN {ods_tms_dic} ds ON ds.id = CAST(o.status AS BIGINT)
LEFT JOIN {ods_tms_dic} dl ON dl.id = CAST(o.collect_type AS BIGINT) LEFT JOIN {ods_tms_dic} dp ON dp.id = CAST(o.payment_type AS BIGINT)"""
_PAY = "o.payment_type, dp.name AS payment_type_name"
_AT = "replace(left({}, 19), 'T', ' ')"
SQL["dwd_tms_order_detail"] = f"""
SELECT {_HEAD}, {_AT.format("c.create_time")} AS order_time, CAST(left(c.create_time, 10) AS DATE) AS dt {_FROM}"""
for _name, _time, _keep in [
    ("pay_suc", "payment_time", "NOT IN ('60010', '60999')"), ("order_cancel", "cancel_time", "= '60020'"),
    ("receive", "receive_time", "NOT IN ('60010', '60020', '60999')"), ("dispatch", "dispatch_time", "NOT IN ('60010', '60020', '60030', '60040', '60999')"),
    ("bound_finish", "bound_finish_time", "NOT IN ('60020', '60030', '60040', '60050')"), ("deliver_suc", "deliver_suc_time", "NOT IN ('60020', '60030', '60040')"),
    ("sign", "sign_time", "NOT IN ('60020', '60030', '60040', '60050')"),
]:
    SQL[f"dwd_tms_{_name}"] = f"""
SELECT {_HEAD}, {_PAY}, {_AT.format("o.update_time")} AS {_time}, CAST(left(o.update_time, 10) AS DATE) AS dt {_FROM} WHERE o.status {_keep}"""
SQL["dwd_tms_order_process"] = f"""
SELECT {_HEAD}, {_PAY}, {_AT.format("c.create_time")} AS order_time, left(c.create_time, 10) AS start_date,
       CASE WHEN o.status IN ('60020', '60030') THEN left(o.update_time, 10) ELSE '9999-12-31' END AS end_date {_FROM}"""
_MS = "strftime(make_timestamp({} * 1000), '%Y-%m-%d %H:%M:%S')"
SQL["dwd_tms_trans_finish"] = f"""
SELECT t.id, t.shift_id, t.line_id, t.start_org_id, t.start_org_name, t.end_org_id, t.end_org_name, t.order_num, t.driver1_emp_id, left(t.driver1_name, 1) || '*' AS driver1_name,
       t.driver2_emp_id, left(t.driver2_name, 1) || '*' AS driver2_name, t.truck_id, md5(t.truck_no) AS truck_no, {_MS.format("t.actual_start_time")} AS actual_start_time,
       {_MS.format("t.actual_end_time")} AS actual_end_time, s.estimated_time, t.actual_distance, (t.actual_end_time - t.actual_start_time) // 1000 AS finish_dur_sec,
       CAST(make_timestamp(t.actual_end_time * 1000) AS DATE) AS dt
FROM {{ods_tms_task}} t LEFT JOIN {{dim_shift}} s ON s.id = t.shift_id WHERE t.actual_end_time IS NOT NULL"""
for _name, _time, _who in [("inbound", "inbound_time", "inbound_emp_id"), ("sort", "sort_time", "sorter_emp_id"), ("outbound", "outbound_time", "outbound_emp_id")]:
    SQL[f"dwd_tms_{_name}"] = f"""
SELECT id, order_id, org_id, {_MS.format(_time)} AS {_time}, {_who}, CAST(make_timestamp({_time} * 1000) AS DATE) AS dt FROM {{ods_tms_bound}} WHERE is_deleted = '0' AND {_time} IS NOT NULL"""

SQL["dws_tms_org_cargo_order_1d"] = """
SELECT a.*, r.name AS city_name FROM (
  SELECT g.id AS org_id, g.org_name, o.sender_city_id AS city_id, o.cargo_type, o.cargo_type_name, count(*) AS order_count, sum(o.amount) AS order_amount, o.dt
  FROM (SELECT order_id, sender_district_id, sender_city_id, cargo_type, cargo_type_name, dt, max(amount) AS amount FROM {dwd_tms_order_detail} GROUP BY ALL) o
  LEFT JOIN {dim_organ} g ON g.region_id = o.sender_district_id GROUP BY ALL) a LEFT JOIN {dim_region} r ON r.id = a.city_id"""


def _placed(source, district, extra):
    return f"""
SELECT g.id AS org_id, g.org_name, c.id AS city_id, c.name AS city_name, p.id AS province_id, p.name AS province_name, count(*) AS order_count{extra}, o.dt
FROM (SELECT order_id, {district} AS district, dt, max(amount) AS amount FROM {{{source}}} GROUP BY ALL) o
LEFT JOIN {{dim_organ}} g ON g.region_id = o.district LEFT JOIN {{dim_region}} d ON d.id = g.region_id LEFT JOIN {{dim_region}} c ON c.id = d.parent_id
LEFT JOIN {{dim_region}} p ON p.id = c.parent_id GROUP BY ALL"""


SQL["dws_tms_org_receive_1d"] = _placed("dwd_tms_receive", "sender_district_id", ", sum(o.amount) AS order_amount")
SQL["dws_tms_org_deliver_1d"] = _placed("dwd_tms_deliver_suc", "receiver_district_id", "")
SQL["dws_tms_dispatch_1d"] = """
SELECT dt, count(*) AS order_count, sum(amount) AS order_amount FROM (SELECT order_id, dt, max(amount) AS amount FROM {dwd_tms_dispatch} GROUP BY ALL) GROUP BY dt"""
SQL["dws_tms_truck_finish_1d"] = """
SELECT f.start_org_id AS org_id, f.start_org_name AS org_name, t.truck_model_type, t.truck_model_type_name, f.dt, count(f.id) AS truck_finish_count,
       sum(f.actual_distance) AS trans_finish_distance, sum(f.finish_dur_sec) AS trans_finish_dur_sec
FROM {dwd_tms_trans_finish} f LEFT JOIN {dim_truck} t ON t.id = f.truck_id GROUP BY ALL"""
SQL["org_place"] = """
SELECT g.id AS org_id, g.org_name, CASE WHEN g.org_level = 1 THEN g.region_id ELSE b.id END AS city_id, CASE WHEN g.org_level = 1 THEN a.name ELSE b.name END AS city_name,
       CASE WHEN g.org_level = 1 THEN b.id ELSE c.id END AS province_id, CASE WHEN g.org_level = 1 THEN b.name ELSE c.name END AS province_name
FROM {dim_organ} g LEFT JOIN {dim_region} a ON a.id = g.region_id LEFT JOIN {dim_region} b ON b.id = a.parent_id LEFT JOIN {dim_region} c ON c.id = b.parent_id"""
SQL["dws_tms_org_sort_1d"] = """
SELECT s.org_id, p.org_name, p.city_id, p.city_name, p.province_id, p.province_name, s.n AS sort_count, s.dt
FROM (SELECT org_id, dt, count(*) AS n FROM {dwd_tms_sort} GROUP BY ALL) s LEFT JOIN {org_place} p ON p.org_id = s.org_id"""
_W2, _W3 = "(VALUES (7), (30)) w(recent_days)", "(VALUES (1), (7), (30)) w(recent_days)"
_IN = "dt > :as_of - w.recent_days AND dt <= :as_of"
_PL = "org_id, org_name, city_id, city_name, province_id, province_name"


def _nd(source, keys, sums):
    k = f"{keys}, " if keys else ""
    return f"SELECT {k}w.recent_days, {sums} FROM {{{source}}}, {_W2} WHERE {_IN} GROUP BY ALL"


_OC = "sum(order_count) AS order_count, sum(order_amount) AS order_amount"
SQL["dws_tms_org_cargo_order_nd"] = _nd("dws_tms_org_cargo_order_1d", "org_id, org_name, city_id, city_name, cargo_type, cargo_type_name", _OC)
SQL["dws_tms_org_receive_nd"] = _nd("dws_tms_org_receive_1d", _PL, _OC)
SQL["dws_tms_dispatch_nd"] = _nd("dws_tms_dispatch_1d", "", _OC)
SQL["dws_tms_org_deliver_nd"] = _nd("dws_tms_org_deliver_1d", _PL, "sum(order_count) AS order_count")
SQL["dws_tms_org_sort_nd"] = _nd("dws_tms_org_sort_1d", _PL, "sum(sort_count) AS sort_count")
_TRIP = "sum(actual_distance) AS trans_finish_distance, sum(finish_dur_sec) AS trans_finish_dur_sec"
SQL["dws_tms_shift_finish_nd"] = f"""
SELECT a.shift_id, p.city_id, p.city_name, a.start_org_id AS org_id, a.start_org_name AS org_name, a.line_id, s.line_name, a.driver1_emp_id, a.driver1_name, a.driver2_emp_id,
       a.driver2_name, t.truck_model_type, t.truck_model_type_name, a.recent_days, a.n AS trans_finish_count, a.trans_finish_distance, a.trans_finish_dur_sec, a.orders AS trans_finish_order_count
FROM (SELECT shift_id, line_id, start_org_id, start_org_name, driver1_emp_id, driver1_name, driver2_emp_id, driver2_name, truck_id, w.recent_days, count(id) AS n, {_TRIP}, sum(order_num) AS orders
      FROM {{dwd_tms_trans_finish}}, {_W2} WHERE {_IN} GROUP BY ALL) a
LEFT JOIN {{org_place}} p ON p.org_id = a.start_org_id LEFT JOIN {{dim_shift}} s ON s.id = a.shift_id LEFT JOIN {{dim_truck}} t ON t.id = a.truck_id"""
SQL["dws_tms_dispatch_td"] = f"SELECT {_OC} FROM {{dws_tms_dispatch_1d}} WHERE dt <= :as_of"
SQL["dws_tms_bound_finish_td"] = """
SELECT count(*) AS order_count, sum(amount) AS order_amount FROM (SELECT order_id, max(amount) AS amount FROM {dwd_tms_bound_finish} WHERE dt <= :as_of GROUP BY order_id)"""


def _win(source, keys, sums):
    k = f"{keys}, " if keys else ""
    return f"(SELECT {k}w.recent_days, {sums} FROM {{{source}}}, {_W3} WHERE {_IN} GROUP BY ALL)"


def _on(a, b, keys):
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in [*keys, "recent_days"])


def _keys(keys, *aliases):
    return ", ".join(f"coalesce({', '.join(f'{a}.{k}' for a in aliases)}) AS {k}" for k in [*keys, "recent_days"])


_RC = "sum(order_count) AS receive_order_count, sum(order_amount) AS receive_order_amount"
_DC = "sum(order_count) AS dispatch_order_count, sum(order_amount) AS dispatch_order_amount"
SQL["ads_tms_trans_order_stats"] = f"""
SELECT :as_of AS dt, {_keys([], "a", "b")}, receive_order_count, receive_order_amount, dispatch_order_count, dispatch_order_amount
FROM {_win("dws_tms_org_receive_1d", "", _RC)} a FULL JOIN {_win("dws_tms_dispatch_1d", "", _DC)} b ON {_on("a", "b", [])}"""
_F = "count(id) AS trans_finish_count, " + _TRIP
SQL["ads_tms_trans_stats"] = f"SELECT :as_of AS dt, * FROM {_win('dwd_tms_trans_finish', '', _F)}"
SQL["ads_tms_order_stats_td"] = """
SELECT :as_of AS dt, d.order_count - b.order_count AS bounding_order_count, d.order_amount - b.order_amount AS bounding_order_amount
FROM {dws_tms_dispatch_td} d, {dws_tms_bound_finish_td} b"""
SQL["ads_tms_order_stats"] = f"SELECT :as_of AS dt, * FROM {_win('dws_tms_org_cargo_order_1d', '', _OC)}"
SQL["ads_tms_cargo_type_stats"] = f"SELECT :as_of AS dt, * FROM {_win('dws_tms_org_cargo_order_1d', 'cargo_type, cargo_type_name', _OC)}"
_AVG = """RATE(trans_finish_distance, trans_finish_count, 4) AS avg_trans_finish_distance,
       RATE(trans_finish_dur_sec, trans_finish_count, 4) AS avg_trans_finish_dur_sec"""
SQL["trip_place"] = "SELECT f.*, p.city_id, p.city_name FROM {dwd_tms_trans_finish} f LEFT JOIN {org_place} p ON p.org_id = f.start_org_id"
for _name, _k, _source, _names in [
    ("ads_tms_city_stats", ["city_id", "city_name"], "trip_place", "city_id, city_name"),
    ("ads_tms_org_stats", ["org_id", "org_name"], "dwd_tms_trans_finish", "start_org_id AS org_id, start_org_name AS org_name"),
]:
    SQL[_name] = f"""
SELECT :as_of AS dt, {_keys(_k, "a", "b")}, order_count, order_amount, trans_finish_count, trans_finish_distance, trans_finish_dur_sec, {_AVG}
FROM {_win("dws_tms_org_cargo_order_1d", ", ".join(_k), _OC)} a FULL JOIN {_win(_source, _names, _F)} b ON {_on("a", "b", _k)}"""
_SUM4 = "sum(trans_finish_count) AS trans_finish_count, sum(trans_finish_distance) AS trans_finish_distance, sum(trans_finish_dur_sec) AS trans_finish_dur_sec"
SQL["ads_tms_shift_stats"] = """
SELECT :as_of AS dt, recent_days, shift_id, trans_finish_count, trans_finish_distance, trans_finish_dur_sec, trans_finish_order_count FROM {dws_tms_shift_finish_nd}"""
SQL["ads_tms_line_stats"] = f"""
SELECT :as_of AS dt, recent_days, line_id, line_name, {_SUM4}, sum(trans_finish_order_count) AS trans_finish_order_count FROM {{dws_tms_shift_finish_nd}} GROUP BY ALL"""
SQL["ads_tms_driver_stats"] = f"""
SELECT :as_of AS dt, *, {_AVG} FROM (
  SELECT recent_days, driver_emp_id, driver_name, {_SUM4} FROM (
    SELECT recent_days, driver1_emp_id AS driver_emp_id, driver1_name AS driver_name, trans_finish_count, CAST(trans_finish_distance AS DOUBLE) AS trans_finish_distance,
           CAST(trans_finish_dur_sec AS DOUBLE) AS trans_finish_dur_sec FROM {{dws_tms_shift_finish_nd}} WHERE driver2_emp_id IS NULL
    UNION ALL SELECT recent_days, driver1_emp_id, driver1_name, trans_finish_count, trans_finish_distance / 2.0, trans_finish_dur_sec / 2.0 FROM {{dws_tms_shift_finish_nd}} WHERE driver2_emp_id IS NOT NULL
    UNION ALL SELECT recent_days, driver2_emp_id, driver2_name, trans_finish_count, trans_finish_distance / 2.0, trans_finish_dur_sec / 2.0 FROM {{dws_tms_shift_finish_nd}} WHERE driver2_emp_id IS NOT NULL
  ) GROUP BY ALL)"""
SQL["ads_tms_truck_stats"] = f"""
SELECT :as_of AS dt, *, {_AVG} FROM (SELECT recent_days, truck_model_type, truck_model_type_name, {_SUM4} FROM {{dws_tms_shift_finish_nd}} GROUP BY ALL)"""
_DS, _SS = "sum(order_count) AS deliver_suc_count", "sum(sort_count) AS sort_count"
SQL["ads_tms_express_stats"] = f"""
SELECT :as_of AS dt, {_keys([], "a", "b")}, deliver_suc_count, sort_count
FROM {_win("dws_tms_org_deliver_1d", "", _DS)} a FULL JOIN {_win("dws_tms_org_sort_1d", "", _SS)} b ON {_on("a", "b", [])}"""
for _level in ("province", "city", "org"):
    _k = [f"{_level}_id", f"{_level}_name"]
    _ks = ", ".join(_k)
    SQL[f"ads_tms_express_{_level}"] = f"""
SELECT :as_of AS dt, {_keys(_k, "x", "c")}, receive_order_count, receive_order_amount, deliver_suc_count, sort_count
FROM (SELECT {_keys(_k, "a", "b")}, deliver_suc_count, sort_count FROM {_win("dws_tms_org_deliver_1d", _ks, _DS)} a
      FULL JOIN {_win("dws_tms_org_sort_1d", _ks, _SS)} b ON {_on("a", "b", _k)}) x
FULL JOIN {_win("dws_tms_org_receive_1d", _ks, _RC)} c ON {_on("x", "c", _k)}"""

"""Page traffic statements."""

SQL: dict[str, str] = {}

_BUCKET = "CAST(('0x' || right(md5('{salt}' || user_id), 3)) AS INT) % {n}"


def _pick(salt, values):
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {_BUCKET.format(salt=salt, n=len(values))} {arms} END"


_SEEN = """(SELECT user_id, page_id, dt, create_time FROM {ods10_click} UNION ALL SELECT user_id, page_id, dt, create_time FROM {ods10_page_view}
  UNION ALL SELECT user_id, source_page_id, dt, create_time FROM {ods10_order})"""
SQL["dim10_user"] = f"""
SELECT user_id, '2025-01-01' AS register_date, {_pick("level", ["VIP", "高级", "普通"])} AS user_level, {_pick("gender", ["男", "女"])} AS gender,
       {_pick("age", ["18-25", "26-35", "36-45", "46+"])} AS age_group, max(create_time) AS create_time, dt FROM {_SEEN} GROUP BY user_id, dt"""
_PREFIX = "regexp_extract({c}, '^[a-z]+')"


def _decode(column, labels, other):
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" if isinstance(v, str) else f"WHEN '{k}' THEN {v}" for k, v in labels.items())
    tail = f"'{other}'" if isinstance(other, str) else other
    return f"CASE {_PREFIX.format(c=column)} {arms} ELSE {tail} END"


_NAMES = {"home": "首页", "product": "商品详情页", "cart": "购物车页", "payment": "支付页", "category": "分类页"}
_TYPES = {**_NAMES, "product": "商品页"}
_LEVELS = {"home": 1, "category": 2, "product": 3, "cart": 4, "payment": 5}
_MODULES = {"banner": "轮播图", "recommend": "推荐商品", "category": "分类导航", "search": "搜索框", "cart": "购物车"}
_MODULE_TYPES = {"banner": "展示类", "recommend": "商品类", "category": "导航类", "search": "功能类", "cart": "功能类"}
_NO_PAY = {k: v for k, v in _NAMES.items() if k != "payment"}
_NO_PAY_TYPES = {k: v for k, v in _TYPES.items() if k != "payment"}
SQL["dim10_page"] = f"""
SELECT page_id, {_decode("page_id", _NAMES, "其他页面")} AS page_name, {_decode("page_id", _TYPES, "其他页")} AS page_type,
       {_decode("page_id", _LEVELS, 6)} AS page_level, max(create_time) AS create_time, dt FROM {_SEEN} GROUP BY page_id, dt"""
SQL["dim10_module"] = f"""
SELECT module_id, {_decode("module_id", _MODULES, "其他模块")} AS module_name, {_decode("module_id", _MODULE_TYPES, "其他类")} AS module_type,
       CASE split_part(module_id, '_', 2) WHEN 'top' THEN '顶部' WHEN 'middle' THEN '中部' WHEN 'bottom' THEN '底部' ELSE '未知' END AS position,
       max(create_time) AS create_time, dt FROM {{ods10_click}} WHERE module_id IS NOT NULL GROUP BY module_id, dt"""
SQL["dim10_session"] = """
SELECT session_id, user_id, dt, min(view_time) AS start_time, max(view_time) AS end_time, sum(stay_time) AS session_duration,
       arg_min(page_id, (view_time, log_id)) AS entry_page_id, arg_max(page_id, (view_time, log_id)) AS exit_page_id,
       count(DISTINCT page_id) AS page_count, max(bounced) AS is_bounced, max(create_time) AS create_time
FROM (SELECT log_id, session_id, user_id, page_id, view_time, stay_time, 0 AS bounced, create_time, dt FROM {ods10_page_view}
      UNION ALL SELECT log_id, session_id, user_id, page_id, click_time, 5, is_bounce, create_time, dt FROM {ods10_click}) GROUP BY session_id, user_id, dt"""
SQL["dim10_order_source_page"] = f"""
SELECT o.source_page_id, {_decode("o.source_page_id", _NO_PAY, "其他页面")} AS source_page_name, {_decode("o.source_page_id", _NO_PAY_TYPES, "其他页")} AS source_page_type,
       coalesce(RATE(o.buyers, v.visitors, 4), 0) AS conversion_rate, o.create_time, o.dt
FROM (SELECT source_page_id, dt, count(DISTINCT user_id) AS buyers, max(create_time) AS create_time FROM {{ods10_order}} GROUP BY ALL) o
LEFT JOIN (SELECT page_id, dt, count(DISTINCT user_id) AS visitors FROM {{ods10_page_view}} GROUP BY ALL) v ON v.page_id = o.source_page_id AND v.dt = o.dt"""
SQL["dim10_date"] = """
SELECT DISTINCT strftime(dt, '%Y%m%d') AS date_key, strftime(dt, '%Y-%m-%d') AS date_value, year(dt) AS year, quarter(dt) AS quarter, month(dt) AS month,
       day(dt) AS day_of_month, isodow(dt) AS day_of_week, CASE WHEN isodow(dt) > 5 THEN 1 ELSE 0 END AS is_weekend FROM {ods10_page_view}"""
SQL["dwd10_click"] = "SELECT *, hour(click_time) AS hour_id FROM {ods10_click}"
SQL["dwd10_page_view"] = "SELECT *, hour(view_time) AS hour_id FROM {ods10_page_view}"
SQL["dwd10_order"] = "SELECT *, hour(order_time) AS hour_id FROM {ods10_order}"
SQL["dwd10_session"] = """
SELECT s.*, coalesce(c.n, 0) AS click_count FROM {dim10_session} s LEFT JOIN (SELECT session_id, dt, count(*) AS n FROM {ods10_click} GROUP BY ALL) c USING (session_id, dt)"""
SQL["dwd10_user_behavior"] = f"""
SELECT u.user_id, u.dt, coalesce(v.n, 0) AS pv_count, coalesce(c.n, 0) AS click_count, coalesce(s.n, 0) AS session_count, coalesce(v.stay, 0) AS total_stay_time,
       coalesce(s.b, 0) AS bounce_count, coalesce(o.n, 0) AS order_count, coalesce(o.amount, 0) AS order_amount, u.created AS create_time
FROM (SELECT user_id, dt, max(create_time) AS created FROM {_SEEN} GROUP BY ALL) u
LEFT JOIN (SELECT user_id, dt, count(*) AS n, sum(stay_time) AS stay FROM {{ods10_page_view}} GROUP BY ALL) v USING (user_id, dt)
LEFT JOIN (SELECT user_id, dt, count(*) AS n FROM {{ods10_click}} GROUP BY ALL) c USING (user_id, dt)
LEFT JOIN (SELECT user_id, dt, count(*) AS n, count(*) FILTER (WHERE is_bounced = 1) AS b FROM {{dim10_session}} GROUP BY ALL) s USING (user_id, dt)
LEFT JOIN (SELECT user_id, dt, count(*) AS n, sum(payment_amount) AS amount FROM {{ods10_order}} GROUP BY ALL) o USING (user_id, dt)"""
SQL["dws10_page_1d"] = """
SELECT p.page_id, p.page_name, p.dt, coalesce(v.pv, 0) AS pv_count, coalesce(c.n, 0) AS click_count, coalesce(v.uv, 0) AS visitor_count,
       coalesce(e.n, 0) AS session_count, coalesce(b.n, 0) AS bounce_count, coalesce(o.n, 0) AS order_count, coalesce(o.amount, 0) AS order_amount,
       coalesce(o.users, 0) AS order_user_count
FROM {dim10_page} p
LEFT JOIN (SELECT page_id, dt, count(*) AS pv, count(DISTINCT user_id) AS uv FROM {dwd10_page_view} GROUP BY ALL) v USING (page_id, dt)
LEFT JOIN (SELECT page_id, dt, count(*) AS n FROM {dwd10_click} GROUP BY ALL) c USING (page_id, dt)
LEFT JOIN (SELECT entry_page_id AS page_id, dt, count(*) AS n FROM {dwd10_session} GROUP BY ALL) e USING (page_id, dt)
LEFT JOIN (SELECT exit_page_id AS page_id, dt, count(*) AS n FROM {dwd10_session} WHERE is_bounced = 1 GROUP BY ALL) b USING (page_id, dt)
LEFT JOIN (SELECT source_page_id AS page_id, dt, count(*) AS n, sum(payment_amount) AS amount, count(DISTINCT user_id) AS users FROM {dwd10_order} GROUP BY ALL) o USING (page_id, dt)"""
SQL["dws10_user_1d"] = "SELECT * EXCLUDE (create_time) FROM {dwd10_user_behavior}"
SQL["dws10_module_1d"] = """
SELECT c.module_id, m.module_name, c.page_id, count(*) AS click_count, count(DISTINCT c.user_id) AS click_user_count, c.dt
FROM {dwd10_click} c JOIN {dim10_module} m ON m.module_id = c.module_id AND m.dt = c.dt GROUP BY ALL"""
SQL["dws10_session_1d"] = "SELECT session_id, user_id, session_duration, page_count, click_count, is_bounced, dt FROM {dwd10_session}"
SQL["dws10_page_path_1d"] = """
WITH s AS (SELECT *, row_number() OVER (PARTITION BY session_id, dt ORDER BY view_time, log_id) AS seq FROM {dwd10_page_view})
SELECT a.page_id AS source_page_id, b.page_id AS target_page_id, a.dt, count(*) AS path_count
FROM s a JOIN s b ON b.session_id = a.session_id AND b.dt = a.dt AND b.seq = a.seq + 1 GROUP BY ALL"""
SQL["ads10_page_module"] = """
SELECT m.page_id, p.page_name, m.module_id, m.module_name, d.module_type, m.click_count, m.click_user_count, coalesce(o.orders, 0) AS order_count,
       coalesce(o.users, 0) AS order_user_count, coalesce(o.amount, 0) AS order_amount, RATE(coalesce(o.users, 0), m.click_user_count, 4) AS click_conversion_rate, m.dt
FROM {dws10_module_1d} m JOIN {dim10_page} p ON p.page_id = m.page_id AND p.dt = m.dt JOIN {dim10_module} d ON d.module_id = m.module_id AND d.dt = m.dt
LEFT JOIN (SELECT c.page_id, c.module_id, c.dt, count(*) AS orders, count(DISTINCT o.user_id) AS users, sum(o.payment_amount) AS amount
           FROM (SELECT DISTINCT page_id, module_id, user_id, dt FROM {dwd10_click}) c JOIN {dwd10_order} o ON o.user_id = c.user_id AND o.dt = c.dt GROUP BY ALL) o
  ON o.page_id = m.page_id AND o.module_id = m.module_id AND o.dt = m.dt"""
SQL["ads10_page_trend"] = """
SELECT s.page_id, s.page_name, s.pv_count, s.visitor_count, s.click_count, coalesce(c.n, 0) AS click_user_count, s.bounce_count,
       CASE WHEN s.session_count > 0 THEN RATE(s.bounce_count, s.session_count, 4) ELSE 0.0 END AS bounce_rate, s.order_count, s.order_user_count, s.order_amount,
       CASE WHEN s.visitor_count > 0 THEN RATE(s.order_user_count, s.visitor_count, 4) ELSE 0.0 END AS visitor_conversion_rate, s.dt
FROM {dws10_page_1d} s LEFT JOIN (SELECT page_id, dt, count(DISTINCT user_id) AS n FROM {dwd10_click} GROUP BY ALL) c USING (page_id, dt)"""
SQL["ads10_hourly_visit"] = """
SELECT v.hour_id, v.pv AS pv_count, v.uv AS visitor_count, coalesce(c.n, 0) AS click_count, coalesce(o.n, 0) AS order_count, coalesce(o.amount, 0) AS order_amount,
       RATE(coalesce(o.n, 0), v.uv, 4) AS conversion_rate, v.dt
FROM (SELECT hour_id, dt, count(*) AS pv, count(DISTINCT user_id) AS uv FROM {dwd10_page_view} GROUP BY ALL) v
LEFT JOIN (SELECT hour_id, dt, count(*) AS n FROM {dwd10_click} GROUP BY ALL) c USING (hour_id, dt)
LEFT JOIN (SELECT hour_id, dt, count(*) AS n, sum(payment_amount) AS amount FROM {dwd10_order} GROUP BY ALL) o USING (hour_id, dt)"""
SQL["ads10_campaign_effect"] = """
SELECT page_id, page_name, pv_count, visitor_count, click_count, order_count, order_user_count, order_amount,
       CASE WHEN visitor_count > 0 THEN RATE(order_user_count, visitor_count, 4) ELSE 0.0 END AS visitor_conversion_rate,
       CASE WHEN click_count > 0 THEN RATE(order_count, click_count, 4) ELSE 0.0 END AS click_conversion_rate, dt FROM {dws10_page_1d}"""


def _favourite(source, label):
    return f"""(SELECT user_id, dt, label FROM (
  SELECT user_id, dt, {label} AS label, row_number() OVER (PARTITION BY user_id, dt ORDER BY count(*) DESC, {label}) AS rn FROM {source} GROUP BY user_id, dt, {label}) WHERE rn = 1)"""


SQL["ads10_user_preference"] = f"""
SELECT u.user_id, p.label AS preferred_page_type, m.label AS preferred_module_type, u.pv_count AS total_pv_count, u.click_count AS total_click_count,
       u.order_amount AS total_order_amount, u.dt
FROM {{dws10_user_1d}} u LEFT JOIN {_favourite("{dwd10_page_view}", _decode("page_id", _TYPES, "其他页"))} p USING (user_id, dt)
LEFT JOIN {_favourite("(SELECT * FROM {dwd10_click} WHERE module_id IS NOT NULL)", _decode("module_id", _MODULE_TYPES, "其他类"))} m USING (user_id, dt)"""

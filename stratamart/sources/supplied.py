"""The warehouse's source tables, expressed over the supplied TPC-H-like tables.

``VIEWS`` are portable SQL: Spark runs them through ``spark.sql`` and the SQL
checks use the same text as common table expressions, so both sides start from
the same rows.  ``{name}`` names a table or another view.  Two functions differ
by dialect and are written ``EPOCH_MS(ts)`` and ``JSON_TEXT(doc, path)``.

``INPUTS`` adds the nested and JSON forms that logs and change streams arrive in.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

RAW = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT))"
PRICE = "CAST(l_extendedprice AS DECIMAL(16,2))"
K = "k"  # the number in an event's props, read once in v_event
PAGE = (
    f"concat(CASE {K} % 5 WHEN 0 THEN 'home' WHEN 1 THEN 'product' WHEN 2 THEN 'cart' "
    f"WHEN 3 THEN 'payment' ELSE 'category' END, '_', {K} % 3)"
)
MODULE = (
    f"concat(CASE {K} % 6 WHEN 0 THEN 'banner' WHEN 1 THEN 'recommend' WHEN 2 THEN 'category' "
    f"WHEN 3 THEN 'search' WHEN 4 THEN 'cart' ELSE 'coupon' END, '_', "
    f"CASE {K} % 4 WHEN 0 THEN 'top' WHEN 1 THEN 'middle' WHEN 2 THEN 'bottom' ELSE 'side' END)"
)
SESSION = "concat(user_id, '_', CAST(CAST(ts AS DATE) AS STRING))"
ISO_DAY = "concat(CAST(CAST({} AS DATE) AS STRING), 'T08:30:15.000Z')"

# Waybill and dictionary codes.
WAYBILL_STATUS = ["60010", "60020", "60030", "60040", "60050", "60060", "60070", "60080", "60999"]
DIC_CODES = WAYBILL_STATUS + [
    "40001", "40002", "40003", "40004", "40005", "40006", "40007",
    "50001", "50002", "70001", "70002", "80001", "80002", "80003", "90001", "90002",
]


def _pick(expr: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


VIEWS: dict[str, str] = {}
VIEWS["v_event"] = "SELECT event_id, ts, user_id, event_type, value, CAST(JSON_TEXT(props, '$.k') AS INT) AS k FROM {events}"

# ---- shop: orders ------------------------------------------------------------
VIEWS["ods_order_info"] = """
SELECT o_orderkey AS id, o_custkey AS user_id, o_custkey % 25 AS province_id, o_orderdate AS create_time,
       CASE o_orderstatus WHEN 'F' THEN '1004' WHEN 'O' THEN '1001' ELSE '1002' END AS order_status,
       CAST(o_totalprice AS DECIMAL(16,2)) AS original_total_amount,
       CASE WHEN o_orderpriority = '1-URGENT'
            THEN CAST(CAST(o_totalprice AS DECIMAL(16,2)) * CAST(0.10 AS DECIMAL(4,2)) AS DECIMAL(16,2))
            ELSE CAST(0 AS DECIMAL(16,2)) END AS activity_reduce_amount,
       CASE WHEN o_orderpriority = '5-LOW'
            THEN CAST(CAST(o_totalprice AS DECIMAL(16,2)) * CAST(0.05 AS DECIMAL(4,2)) AS DECIMAL(16,2))
            ELSE CAST(0 AS DECIMAL(16,2)) END AS coupon_reduce_amount,
       CAST(CAST(o_totalprice AS DECIMAL(16,2)) * CAST(0.90 AS DECIMAL(4,2)) AS DECIMAL(16,2)) AS total_amount
FROM {orders}"""

VIEWS["ods_order_detail"] = f"""
SELECT {LINE_ID} AS id, l_orderkey AS order_id, l_partkey AS sku_id, concat('sku-', l_partkey) AS sku_name,
       l_shipdate AS create_time, l_suppkey AS source_id, concat('240', l_linenumber) AS source_type,
       CAST(l_quantity AS INT) AS sku_num, {PRICE} AS order_price,
       CASE WHEN l_discount > 0 THEN CAST({PRICE} * CAST(l_quantity AS INT) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2)) END
         AS split_activity_amount,
       CASE WHEN l_tax > 0 THEN CAST({PRICE} * CAST(l_quantity AS INT) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,2)) END
         AS split_coupon_amount,
       CAST({PRICE} * CAST(l_quantity AS INT) AS DECIMAL(16,2))
         - CAST({PRICE} * CAST(l_quantity AS INT) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2))
         - CAST({PRICE} * CAST(l_quantity AS INT) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,2)) AS split_total_amount
FROM {{lineitem}}"""

VIEWS["ods_order_detail_activity"] = f"""
SELECT {LINE_ID} AS order_detail_id, l_partkey AS activity_id, l_partkey AS activity_rule_id
FROM {{lineitem}} WHERE l_discount > 0"""

VIEWS["ods_order_detail_coupon"] = f"""
SELECT {LINE_ID} AS order_detail_id, l_suppkey AS coupon_id FROM {{lineitem}} WHERE l_tax > 0"""

VIEWS["ods_payment_info"] = """
SELECT o_orderkey AS id, o_custkey AS user_id, o_orderkey AS order_id,
       concat('110', substr(o_orderpriority, 1, 1)) AS payment_type,
       o_orderdate + INTERVAL '1' SECOND * CAST(o_orderkey * 7919 % 172800 AS INT) AS callback_time,
       CAST(CAST(o_totalprice AS DECIMAL(16,2)) * CAST(0.90 AS DECIMAL(4,2)) AS DECIMAL(16,2)) AS total_amount,
       '1602' AS payment_status
FROM {orders} WHERE o_orderstatus <> 'O'"""

VIEWS["ods_order_status_log"] = """
SELECT o_orderkey AS order_id, '1004' AS order_status,
       o_orderdate + INTERVAL '1' HOUR * CAST(120 + o_orderkey % 100 AS INT) AS operate_time
FROM {orders} WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, '1002', o_orderdate + INTERVAL '1' HOUR FROM {orders} WHERE o_orderstatus <> 'O'"""

VIEWS["ods_coupon_use"] = """
SELECT o_orderkey AS id, o_orderkey % 100 AS coupon_id, o_custkey AS user_id, o_orderkey AS order_id,
       o_orderdate AS used_time
FROM {orders} WHERE o_orderstatus = 'F'"""

# ---- shop: dictionary, promotions, places, goods, users -----------------------
VIEWS["ods_base_dic"] = "\nUNION ALL\n".join(
    f"SELECT concat('{p}0', r_regionkey + 1) AS dic_code, concat('type {p} ', r_name) AS dic_name, '{p}' AS parent_code FROM {{region}}"
    for p in ("11", "12", "13", "15", "31", "32", "33")
)
VIEWS["ods_activity_rule"] = """
SELECT p_partkey AS id, p_partkey AS activity_id, concat('310', p_size % 3 + 1) AS activity_type,
       CAST(p_size * 100 AS DECIMAL(16,2)) AS condition_amount, p_size % 5 + 1 AS condition_num,
       CAST(p_size * 3 AS DECIMAL(16,2)) AS benefit_amount, p_size % 9 + 1 AS benefit_discount, p_size % 3 + 1 AS benefit_level
FROM {part}"""
VIEWS["ods_activity_info"] = """
SELECT p_partkey AS id, concat('activity ', p_name) AS activity_name, concat('310', p_size % 3 + 1) AS activity_type,
       p_type AS activity_desc, TIMESTAMP '2001-01-01 00:00:00' AS start_time, TIMESTAMP '2001-12-31 00:00:00' AS end_time,
       TIMESTAMP '2000-12-01 00:00:00' AS create_time
FROM {part} WHERE p_size <= 40"""
VIEWS["ods_coupon_info"] = """
SELECT s_suppkey AS id, concat('coupon ', s_name) AS coupon_name, concat('320', s_suppkey % 3 + 1) AS coupon_type,
       CAST(s_suppkey % 10 * 50 AS DECIMAL(16,2)) AS condition_amount, s_suppkey % 4 + 2 AS condition_num,
       s_suppkey % 7 AS activity_id, CAST(s_suppkey % 20 + 5 AS DECIMAL(16,2)) AS benefit_amount,
       s_suppkey % 9 + 1 AS benefit_discount, TIMESTAMP '2001-01-01 00:00:00' AS create_time,
       concat('330', s_suppkey % 3 + 1) AS range_type, 100 AS limit_num, s_suppkey % 50 AS taken_count,
       TIMESTAMP '2001-01-01 00:00:00' AS start_time, TIMESTAMP '2001-12-31 00:00:00' AS end_time,
       TIMESTAMP '2001-01-02 00:00:00' AS operate_time, TIMESTAMP '2002-01-31 00:00:00' AS expire_time
FROM {supplier}"""
VIEWS["ods_promotion_pos"] = """
SELECT p_partkey AS id, p_type AS pos_type, p_brand AS promotion_type, TIMESTAMP '2001-01-01 00:00:00' AS create_time,
       TIMESTAMP '2001-01-02 00:00:00' AS operate_time FROM {part}"""
VIEWS["ods_promotion_refer"] = """
SELECT s_suppkey AS id, s_name AS refer_name, TIMESTAMP '2001-01-01 00:00:00' AS create_time,
       TIMESTAMP '2001-01-02 00:00:00' AS operate_time FROM {supplier}"""
VIEWS["ods_base_province"] = """
SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region_id, concat('0', 10 + n_nationkey) AS area_code,
       concat('CN-', n_nationkey) AS iso_code, concat('CN-', lpad(CAST(n_nationkey AS STRING), 2, '0')) AS iso_3166_2
FROM {nation}"""
VIEWS["ods_base_region"] = "SELECT r_regionkey AS id, r_name AS region_name FROM {region}"
VIEWS["ods_sku_info"] = """
SELECT p_partkey AS id, CAST(p_retailprice AS DECIMAL(16,2)) AS price, p_name AS sku_name, concat(p_type, ' ', p_name) AS sku_desc,
       CAST(p_size AS DECIMAL(16,2)) AS weight, CASE WHEN p_size % 10 = 0 THEN '0' ELSE '1' END AS is_sale,
       p_type AS spu_id, p_size AS category3_id, p_brand AS tm_id, TIMESTAMP '2000-01-01 00:00:00' AS create_time
FROM {part}"""
VIEWS["ods_spu_info"] = "SELECT DISTINCT p_type AS id, lower(p_type) AS spu_name FROM {part}"
VIEWS["ods_base_category3"] = "SELECT DISTINCT p_size AS id, concat('third ', p_size) AS name, p_size % 10 AS category2_id FROM {part}"
VIEWS["ods_base_category2"] = "SELECT DISTINCT p_size % 10 AS id, concat('second ', p_size % 10) AS name, p_size % 10 % 3 AS category1_id FROM {part}"
VIEWS["ods_base_category1"] = "SELECT DISTINCT p_size % 10 % 3 AS id, concat('first ', p_size % 10 % 3) AS name FROM {part}"
VIEWS["ods_base_trademark"] = "SELECT DISTINCT p_brand AS id, concat('maker of ', p_brand) AS tm_name FROM {part}"
VIEWS["ods_sku_attr_value"] = """
SELECT p_partkey AS sku_id, 1 AS attr_id, p_size AS value_id, 'size' AS attr_name, CAST(p_size AS STRING) AS value_name FROM {part}
UNION ALL SELECT p_partkey, 2, p_size % 6, 'type', p_type FROM {part} WHERE p_size <> 13"""
VIEWS["ods_sku_sale_attr_value"] = """
SELECT p_partkey AS sku_id, 9 AS sale_attr_id, p_size % 4 AS sale_attr_value_id, 'colour' AS sale_attr_name,
       substr(p_name, 1, 3) AS sale_attr_value_name FROM {part} WHERE p_size % 2 = 0"""
VIEWS["ods_user_info"] = """
SELECT c_custkey AS id, c_name AS name,
       CASE WHEN c_custkey % 5 = 4 THEN concat('99', c_custkey) ELSE concat('13', lpad(CAST(c_custkey % 1000000000 AS STRING), 9, '0')) END AS phone_num,
       CASE WHEN c_custkey % 7 = 6 THEN 'no mail' ELSE concat(lower(c_mktsegment), c_custkey, '@example.com') END AS email,
       c_mktsegment AS user_level, CAST(c_custkey % 20000 AS INT) AS birthday, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
       TIMESTAMP '2024-01-01 09:30:00' + INTERVAL '1' DAY * CAST(c_custkey % 30 AS INT) AS create_time,
       TIMESTAMP '2024-01-31 00:00:00' AS operate_time
FROM {customer}"""

# ---- shop: behaviour -----------------------------------------------------------
VIEWS["ods_cart_info"] = f"""
SELECT event_id AS id, user_id, event_id % 200 AS sku_id, concat('sku-', event_id % 200) AS sku_name, {K} % 5 + 1 AS sku_num,
       CASE WHEN {K} % 2 = 0 THEN '0' ELSE '1' END AS is_ordered, ts AS create_time
FROM {{v_event}} WHERE event_type = 'click'"""
VIEWS["ods_favor_info"] = """
SELECT event_id AS id, user_id, event_id % 200 AS sku_id, ts AS create_time FROM {events} WHERE event_type = 'view'"""
VIEWS["v_log"] = f"""
SELECT event_id, ts, EPOCH_MS(CAST(ts AS TIMESTAMP)) AS ts_ms, k,
       CASE WHEN {K} % 10 = 9 THEN NULL ELSE user_id END AS uid, concat('m', user_id) AS mid, {SESSION} AS sid,
       concat('ch', user_id % 5) AS ch, user_id % 25 AS ar, concat('brand', user_id % 7) AS ba, concat('model', user_id % 11) AS md,
       CASE WHEN user_id % 2 = 0 THEN 'Android' ELSE 'iOS' END AS os, concat('v', user_id % 3) AS vc,
       CASE event_type WHEN 'signup' THEN '1' ELSE '0' END AS is_new,
       CASE event_type WHEN 'view' THEN 'good_detail' WHEN 'click' THEN 'home' WHEN 'purchase' THEN 'payment' WHEN 'signup' THEN 'register' END AS page_id,
       CASE WHEN {K} % 3 = 0 THEN 'home' END AS last_page_id,
       CAST(event_id % 200 AS STRING) AS item, 'sku_id' AS item_type, CAST({K} % 4 AS STRING) AS from_pos_id,
       CAST({K} % 6 AS STRING) AS from_pos_seq, CAST({K} % 8 AS STRING) AS refer_id, CAST(floor(value * 1000) AS BIGINT) AS during_time,
       event_type
FROM {{v_event}}"""

# ---- product macro report --------------------------------------------------------
VIEWS["v01_page"] = """
SELECT ts_ms AS ts, CAST(ts AS DATE) AS dt, CAST(uid AS STRING) AS user_id, item AS sku_id, page_id, last_page_id, during_time,
       from_pos_id AS source_type, mid, ba, ch FROM {v_log}"""
VIEWS["v01_cart"] = f"""
SELECT CASE WHEN {K} % 9 = 0 THEN 'update' ELSE 'insert' END AS type, EPOCH_MS(CAST(ts AS TIMESTAMP)) AS ts, CAST(ts AS DATE) AS dt,
       CAST(user_id AS STRING) AS user_id, CAST(event_id % 200 AS STRING) AS sku_id, ts AS create_time,
       CAST({K} % 4 AS STRING) AS source_type, CAST({K} % 6 AS STRING) AS source_id, CAST({K} % 5 + 1 AS BIGINT) AS sku_num
FROM {{v_event}} WHERE event_type = 'click'"""
VIEWS["v01_order"] = f"""
SELECT CASE WHEN {K} % 11 = 0 THEN 'update' ELSE 'insert' END AS type, EPOCH_MS(CAST(ts AS TIMESTAMP)) AS ts, CAST(ts AS DATE) AS dt,
       CAST(user_id AS STRING) AS user_id, CAST(event_id AS STRING) AS order_id, CAST(event_id % 200 AS STRING) AS sku_id, ts AS create_time,
       CAST({K} % 4 AS STRING) AS source_type, CAST({K} % 6 AS STRING) AS source_id, CAST({K} % 60 + 1 AS BIGINT) AS sku_num,
       CAST(value AS DECIMAL(16,2)) AS split_total_amount
FROM {{v_event}} WHERE event_type = 'purchase'"""
VIEWS["v01_payment"] = f"""
SELECT 'insert' AS type, EPOCH_MS(CAST(ts AS TIMESTAMP)) AS ts, CAST(ts AS DATE) AS dt, CAST(user_id AS STRING) AS user_id,
       CAST(event_id AS STRING) AS order_id, CAST(CAST(value AS DECIMAL(16,2)) * 40 AS DECIMAL(16,2)) AS total_amount, ts AS payment_time
FROM {{v_event}} WHERE event_type = 'purchase' AND {K} % 3 <> 0"""
VIEWS["v01_sku"] = "SELECT CAST(p_partkey AS STRING) AS id, CAST(p_retailprice - 895 AS DECIMAL(16,2)) * CAST(p_size % 4 AS INT) AS price FROM {part}"

# ---- product 360 -------------------------------------------------------------------
VIEWS["ods03_product_info"] = """
SELECT p_partkey AS item_id, p_name AS item_name, p_type AS category_id, p_brand AS brand_id, TIMESTAMP '2000-01-01 00:00:00' AS create_time,
       CASE WHEN p_size = 50 THEN 1 ELSE 0 END AS is_deleted FROM {part}"""
VIEWS["ods03_sku_info"] = """
SELECT p_partkey AS sku_id, p_partkey % 97 AS item_id, p_type AS spec, p_size AS stock, p_retailprice AS sku_price,
       TIMESTAMP '2000-01-01 00:00:00' AS create_time FROM {part}"""
VIEWS["ods03_user_info"] = """
SELECT c_custkey AS user_id, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, CAST(18 + c_custkey % 50 AS INT) AS age,
       c_nationkey AS region, TIMESTAMP '2000-01-01 00:00:00' AS register_time FROM {customer}"""
VIEWS["ods03_order_detail"] = """
SELECT l_orderkey AS order_id, l_orderkey % 10007 AS user_id, l_partkey % 97 AS item_id, l_partkey AS sku_id,
       CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price, CAST(l_quantity AS INT) AS quantity, l_shipdate AS order_time,
       l_linestatus AS order_status FROM {lineitem}"""
VIEWS["ods03_payment_info"] = f"""
SELECT {LINE_ID} AS payment_id, l_orderkey AS order_id, {PRICE} AS pay_amount, concat('channel', l_linenumber) AS pay_channel,
       l_shipdate AS pay_time FROM {{lineitem}} WHERE l_linestatus = 'F'"""
VIEWS["ods03_search_log"] = f"""
SELECT event_id AS search_id, user_id, concat('word', {K} % 20) AS keyword, ts AS search_time FROM {{v_event}} WHERE event_type = 'view'"""
VIEWS["ods03_content_log"] = f"""
SELECT {LINE_ID} AS content_id, l_orderkey % 10007 AS user_id, l_partkey % 97 AS item_id, l_returnflag AS content_type,
       CASE l_linenumber WHEN 1 THEN 'click' WHEN 2 THEN 'cart' WHEN 3 THEN 'collect' ELSE 'view' END AS interaction_type,
       l_shipdate AS interaction_time FROM {{lineitem}}"""
VIEWS["ods03_comment_info"] = f"""
SELECT {LINE_ID} AS comment_id, l_orderkey % 10007 AS user_id, l_partkey % 97 AS item_id, l_partkey AS sku_id,
       CAST(l_linenumber % 5 + 1 AS DOUBLE) AS score, concat('comment on ', l_partkey) AS comment_text, l_shipdate AS comment_time
FROM {{lineitem}} WHERE l_returnflag = 'R'"""
VIEWS["fact_log"] = "SELECT user_id, concat('d', user_id % 3) AS device_id, CAST(ts AS DATE) AS login_date FROM {events}"

# ---- page traffic ---------------------------------------------------------------------
VIEWS["ods10_click"] = f"""
SELECT event_id AS log_id, user_id, {SESSION} AS session_id, {PAGE} AS page_id, CASE WHEN {K} = 77 THEN NULL ELSE {MODULE} END AS module_id,
       ts AS click_time, CASE WHEN {K} % 10 = 0 THEN 1 ELSE 0 END AS is_bounce, ts AS create_time, CAST(ts AS DATE) AS dt
FROM {{v_event}} WHERE event_type = 'click'"""
VIEWS["ods10_page_view"] = f"""
SELECT event_id AS log_id, user_id, {SESSION} AS session_id, {PAGE} AS page_id, ts AS view_time, CAST(floor(value) AS INT) AS stay_time,
       ts AS create_time, CAST(ts AS DATE) AS dt
FROM {{v_event}} WHERE event_type IN ('view', 'signup', 'error')"""
VIEWS["ods10_order"] = f"""
SELECT event_id AS order_id, user_id, ts AS order_time, CAST(value AS DECIMAL(16,2)) AS payment_amount, {PAGE} AS source_page_id,
       ts AS create_time, CAST(ts AS DATE) AS dt
FROM {{v_event}} WHERE event_type = 'purchase'"""

# ---- logistics ------------------------------------------------------------------------------
VIEWS["ods_tms_region"] = """
SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, CAST(0 AS BIGINT) AS parent_id, r_name AS name, concat('R', r_regionkey) AS dict_code, substr(r_name, 1, 2) AS short_name, '0' AS is_deleted FROM {region}
UNION ALL SELECT CAST(100 + n_nationkey AS BIGINT), CAST(n_regionkey + 1 AS BIGINT), n_name, concat('N', n_nationkey), substr(n_name, 8, 2), '0' FROM {nation}
UNION ALL SELECT 1000 + s_suppkey, CAST(100 + s_nationkey AS BIGINT), concat('district ', s_suppkey), concat('S', s_suppkey), concat('d', s_suppkey),
       CASE WHEN s_suppkey % 37 = 36 THEN '1' ELSE '0' END FROM {supplier}"""
VIEWS["ods_tms_organ"] = """
SELECT CAST(100 + n_nationkey AS BIGINT) AS id, concat('hub ', n_name) AS org_name, 1 AS org_level, CAST(100 + n_nationkey AS BIGINT) AS region_id,
       CAST(NULL AS BIGINT) AS org_parent_id, '0' AS is_deleted FROM {nation}
UNION ALL SELECT 1000 + s_suppkey, concat('branch ', s_name), 2, 1000 + s_suppkey, CAST(100 + s_nationkey AS BIGINT), '0' FROM {supplier}"""
VIEWS["ods_tms_dic"] = f"""
SELECT CAST({_pick("n_nationkey", DIC_CODES)} AS BIGINT) AS id, concat('label ', n_nationkey) AS name, '0' AS is_deleted FROM {{nation}}"""
VIEWS["ods_tms_complex"] = """
SELECT s_suppkey AS id, concat('complex ', s_suppkey) AS complex_name, CAST(s_nationkey % 5 + 1 AS BIGINT) AS province_id,
       CAST(100 + s_nationkey AS BIGINT) AS city_id, 1000 + s_suppkey AS district_id, concat('district ', s_suppkey) AS district_name,
       CASE WHEN s_suppkey % 29 = 28 THEN '1' ELSE '0' END AS is_deleted FROM {supplier}"""
VIEWS["ods_tms_courier_complex"] = """
SELECT c_custkey AS courier_emp_id, c_custkey % 90 AS complex_id, CASE WHEN c_custkey % 17 = 16 THEN '1' ELSE '0' END AS is_deleted FROM {customer}"""
VIEWS["ods_tms_courier"] = """
SELECT c_custkey AS id, c_custkey AS emp_id, CAST(100 + c_nationkey AS BIGINT) AS org_id, concat('13', lpad(CAST(c_custkey AS STRING), 9, '0')) AS working_phone,
       CASE WHEN c_custkey % 2 = 0 THEN '80001' ELSE '80002' END AS express_type, '0' AS is_deleted FROM {customer}"""
VIEWS["ods_tms_shift"] = """
SELECT DISTINCT l_suppkey * 10 + l_linenumber AS id, l_suppkey AS line_id, concat(8 + l_linenumber, ':00') AS start_time,
       l_suppkey AS driver1_emp_id, l_suppkey + 1 AS driver2_emp_id, l_suppkey AS truck_id, l_suppkey * 10 + 8 - l_linenumber AS pair_shift_id,
       '0' AS is_deleted FROM {lineitem}"""
VIEWS["ods_tms_line"] = """
SELECT s_suppkey AS id, concat('line ', s_name) AS name, concat('L', s_suppkey) AS line_no, '1' AS line_level, CAST(100 + s_nationkey AS BIGINT) AS org_id,
       CASE WHEN s_suppkey % 2 = 0 THEN '50001' ELSE '50002' END AS transport_line_type_id, 1000 + s_suppkey AS start_org_id,
       concat('branch ', s_name) AS start_org_name, CAST(100 + s_nationkey AS BIGINT) AS end_org_id, concat('hub NATION_', s_nationkey) AS end_org_name,
       s_suppkey + 1 AS pair_line_id, CAST(s_suppkey % 300 + 10 AS DECIMAL(16,2)) AS distance, CAST(s_suppkey % 90 AS DECIMAL(16,2)) AS cost,
       s_suppkey % 48 AS estimated_time, '0' AS is_deleted FROM {supplier}"""
VIEWS["ods_tms_driver"] = """
SELECT c_custkey AS id, c_custkey AS emp_id, CAST(100 + c_nationkey AS BIGINT) AS org_id, c_custkey % 25 AS team_id, c_mktsegment AS license_type,
       TIMESTAMP '1999-05-01 00:00:00' AS init_license_date, TIMESTAMP '2009-05-01 00:00:00' AS expire_date, concat('LN', c_custkey) AS license_no,
       c_custkey % 2 AS is_enabled, '0' AS is_deleted FROM {customer}"""
VIEWS["ods_tms_team"] = """
SELECT CAST(n_nationkey AS BIGINT) AS id, concat('team ', n_name) AS name, concat('T', n_nationkey) AS team_no, CAST(100 + n_nationkey AS BIGINT) AS org_id,
       n_nationkey * 3 AS manager_emp_id, '0' AS is_deleted FROM {nation}"""
VIEWS["ods_tms_truck"] = """
SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS team_id, concat('plate', s_suppkey) AS truck_no, s_suppkey % 5 AS truck_model_id,
       concat('gps', s_suppkey) AS device_gps_id, concat('eng', s_suppkey) AS engine_no, TIMESTAMP '1998-01-01 00:00:00' AS license_registration_date,
       TIMESTAMP '2001-01-01 00:00:00' AS license_last_check_date, TIMESTAMP '2003-01-01 00:00:00' AS license_expire_date, s_suppkey % 2 AS is_enabled,
       CASE WHEN s_suppkey % 41 = 40 THEN '1' ELSE '0' END AS is_deleted FROM {supplier}"""
VIEWS["ods_tms_model"] = """
SELECT CAST(r_regionkey AS BIGINT) AS id, concat('model ', r_name) AS model_name, CASE r_regionkey % 3 WHEN 0 THEN '80001' WHEN 1 THEN '80002' ELSE '80003' END AS model_type,
       concat('M', r_regionkey) AS model_no, CASE r_regionkey % 2 WHEN 0 THEN '90001' ELSE '90002' END AS brand, r_regionkey * 10 AS truck_weight,
       r_regionkey * 20 AS load_weight, r_regionkey * 30 AS total_weight, 'E5' AS eev, 9 AS boxcar_len, 3 AS boxcar_wd, 3 AS boxcar_hg,
       120 AS max_speed, 400 AS oil_vol, '0' AS is_deleted FROM {region}"""
VIEWS["ods_tms_user"] = """
SELECT id, concat('login', id) AS login_name, name AS nick_name, concat('pw', id) AS passwd, name AS real_name, phone_num, email, user_level, birthday, gender,
       EPOCH_MS(CAST(create_time AS TIMESTAMP)) AS create_time, CASE WHEN id % 31 = 30 THEN '1' ELSE '0' END AS is_deleted FROM {ods_user_info}"""
VIEWS["ods_tms_address"] = f"""
SELECT c_custkey AS id, c_custkey AS user_id, CASE WHEN c_custkey % 4 = 3 THEN 'none' ELSE concat('15', lpad(CAST(c_custkey AS STRING), 9, '0')) END AS phone,
       c_nationkey % 5 + 1 AS province_id, 100 + c_nationkey AS city_id, 1000 + c_custkey % 100 AS district_id, c_custkey % 90 AS complex_id,
       concat('street ', c_custkey) AS address, c_custkey % 2 AS is_default, '2000-03-04T05:06:07.000Z' AS create_time, '0' AS is_deleted FROM {{customer}}"""
VIEWS["ods_tms_cargo"] = f"""
SELECT {LINE_ID} AS id, l_orderkey AS order_id, concat('4000', l_linenumber) AS cargo_type, l_linenumber * 10 AS volume_length, l_linenumber * 5 AS volume_width,
       l_linenumber * 2 AS volume_height, CAST(l_quantity AS DECIMAL(16,2)) AS weight, {ISO_DAY.format('l_shipdate')} AS create_time,
       CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN '1' ELSE '0' END AS is_deleted FROM {{lineitem}}"""
VIEWS["ods_tms_order"] = f"""
SELECT o_orderkey AS id, concat('NO', o_orderkey) AS order_no, {_pick("o_orderkey % 9", WAYBILL_STATUS)} AS status,
       CASE WHEN o_orderkey % 2 = 0 THEN '50001' ELSE '50002' END AS collect_type, o_custkey AS user_id,
       o_orderkey % 90 AS receiver_complex_id, o_orderkey % 5 + 1 AS receiver_province_id, 100 + o_orderkey % 25 AS receiver_city_id,
       1000 + o_orderkey % 100 AS receiver_district_id, concat('Receiver', o_orderkey) AS receiver_name,
       o_custkey % 90 AS sender_complex_id, o_custkey % 5 + 1 AS sender_province_id, 100 + o_custkey % 25 AS sender_city_id,
       1000 + o_custkey % 100 AS sender_district_id, concat('Sender', o_custkey) AS sender_name,
       CASE WHEN o_orderkey % 3 = 0 THEN '70001' ELSE '70002' END AS payment_type, o_orderkey % 4 + 1 AS cargo_num, CAST(o_totalprice AS DECIMAL(16,2)) AS amount,
       EPOCH_MS(CAST(o_orderdate AS TIMESTAMP)) + 259200000 AS estimate_arrive_time, CAST(o_orderkey % 500 AS DECIMAL(16,2)) AS distance,
       {ISO_DAY.format('o_orderdate')} AS update_time, CASE WHEN o_orderkey % 53 = 52 THEN '1' ELSE '0' END AS is_deleted FROM {{orders}}"""
VIEWS["ods_tms_task"] = f"""
SELECT {LINE_ID} AS id, l_suppkey * 10 + l_linenumber AS shift_id, l_suppkey AS line_id,
       CASE WHEN l_linenumber = 1 THEN 100 + l_suppkey % 25 ELSE 1000 + l_suppkey END AS start_org_id, concat('org of ', l_suppkey, CASE WHEN l_linenumber = 1 THEN ' hub' ELSE ' branch' END) AS start_org_name,
       100 + l_suppkey % 25 AS end_org_id, concat('end of ', l_suppkey) AS end_org_name, CAST(l_linenumber AS BIGINT) AS order_num,
       l_suppkey AS driver1_emp_id, concat('D', l_suppkey) AS driver1_name,
       CASE WHEN l_partkey % 7 <> 0 THEN l_partkey % 7 END AS driver2_emp_id, CASE WHEN l_partkey % 7 <> 0 THEN concat('E', l_partkey % 7) END AS driver2_name,
       l_suppkey AS truck_id, concat('plate', l_suppkey) AS truck_no,
       EPOCH_MS(CAST(l_shipdate AS TIMESTAMP)) - CAST(l_quantity AS BIGINT) * 3600000 AS actual_start_time,
       CASE WHEN l_linestatus = 'F' OR l_tax > 0 THEN EPOCH_MS(CAST(l_shipdate AS TIMESTAMP)) END AS actual_end_time,
       CAST(l_quantity * 10 AS DECIMAL(16,2)) AS actual_distance, '0' AS is_deleted FROM {{lineitem}}"""
VIEWS["ods_tms_bound"] = f"""
SELECT {LINE_ID} AS id, l_orderkey AS order_id, CASE WHEN l_linenumber = 1 THEN 100 + l_suppkey % 25 ELSE 1000 + l_suppkey END AS org_id,
       EPOCH_MS(CAST(l_shipdate AS TIMESTAMP)) AS inbound_time, l_suppkey AS inbound_emp_id,
       CASE WHEN l_linenumber <> 2 THEN EPOCH_MS(CAST(l_shipdate AS TIMESTAMP)) + 3600000 END AS sort_time, l_suppkey + 1 AS sorter_emp_id,
       CASE WHEN l_linestatus = 'F' THEN EPOCH_MS(CAST(l_shipdate AS TIMESTAMP)) + 90000000 END AS outbound_time, l_suppkey + 2 AS outbound_emp_id,
       CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN '1' ELSE '0' END AS is_deleted FROM {{lineitem}}"""

# ---- customer-service coupons ---------------------------------------------------------------
VIEWS["ods_cs_agent"] = """
SELECT s_suppkey AS customer_service_id, s_name AS customer_service_name, concat('department ', s_nationkey) AS department,
       concat('position ', s_suppkey % 3) AS position, DATE '1999-01-01' AS hire_date, CASE WHEN s_suppkey % 19 = 18 THEN NULL ELSE 'on' END AS status,
       TIMESTAMP '2001-01-01 00:00:00' AS create_time, TIMESTAMP '2001-01-02 00:00:00' AS update_time FROM {supplier}"""
VIEWS["ods_cs_activity"] = """
SELECT p_partkey AS activity_id, concat('activity ', p_name) AS activity_name,
       CASE p_size % 3 WHEN 0 THEN '商品级' WHEN 1 THEN 'SKU级' ELSE 'x' END AS activity_level,
       CASE p_size % 4 WHEN 0 THEN '进行中' WHEN 1 THEN '已结束' WHEN 2 THEN '已暂停' ELSE 'x' END AS activity_status,
       TIMESTAMP '2001-01-01 00:00:00' AS activity_start_time, TIMESTAMP '2001-01-01 00:00:00' + INTERVAL '1' DAY * p_size AS activity_end_time,
       CASE p_size % 3 WHEN 0 THEN '固定优惠' WHEN 1 THEN '自定义优惠' ELSE 'x' END AS coupon_type, p_partkey % 100 AS creator_id,
       TIMESTAMP '2001-01-01 00:00:00' AS create_time, TIMESTAMP '2001-01-02 00:00:00' AS update_time, p_size AS max_valid_days, 100 AS max_products FROM {part}"""
VIEWS["ods_cs_customer"] = """
SELECT c_custkey AS customer_id, c_name AS customer_name, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
       CAST(18 + c_custkey % 50 AS INT) AS age, c_mktsegment AS level, TIMESTAMP '2000-01-01 00:00:00' AS register_time,
       TIMESTAMP '2001-01-01 00:00:00' AS last_login_time FROM {customer}"""
VIEWS["ods_cs_send"] = f"""
SELECT {LINE_ID} AS send_id, l_partkey AS activity_id, l_partkey AS product_id, l_partkey * 10 + l_linenumber AS sku_id, l_suppkey AS customer_service_id,
       l_orderkey % 10007 AS customer_id, CAST({PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2)) AS coupon_amount, l_shipdate AS send_time,
       l_shipdate + INTERVAL '2' DAY AS expire_time, 48 AS usage_valid_hours, concat('channel', l_linenumber) AS send_channel, l_returnflag AS remark,
       l_linestatus AS send_status FROM {{lineitem}} WHERE l_discount > 0"""
VIEWS["ods_cs_usage"] = f"""
SELECT concat('u', {LINE_ID}) AS usage_id, {LINE_ID} AS send_id, l_orderkey AS order_id, l_partkey AS activity_id, l_partkey AS product_id,
       l_partkey * 10 + l_linenumber AS sku_id, l_suppkey AS customer_service_id, l_orderkey % 10007 AS customer_id,
       CAST({PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2)) AS coupon_amount, l_shipdate + INTERVAL '5' HOUR AS usage_time, {PRICE} AS order_amount,
       {PRICE} - CAST({PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2)) AS actual_payment, l_returnflag AS order_status,
       l_shipdate + INTERVAL '6' HOUR AS payment_time FROM {{lineitem}} WHERE l_discount > 0 AND l_linestatus = 'F'"""
VIEWS["ods_cs_product"] = """
SELECT p_partkey AS activity_id, p_partkey AS product_id, p_partkey * 10 + 1 + p_size % 7 AS sku_id, CAST(p_size AS DECIMAL(16,2)) AS coupon_amount,
       p_size % 3 + 1 AS max_usage_count, CASE WHEN p_size % 5 = 0 THEN '无效' ELSE '有效' END AS product_status, TIMESTAMP '2001-01-01 00:00:00' AS add_time,
       CASE WHEN p_size % 4 = 0 THEN TIMESTAMP '2001-02-01 00:00:00' END AS remove_time, CAST(p_retailprice AS DECIMAL(16,2)) AS min_price,
       CAST(p_retailprice AS DECIMAL(16,2)) AS estimated_price FROM {part}"""

# ---- refund topic -------------------------------------------------------------------------------
VIEWS["ods_rf_order"] = """
SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderkey % 200 AS sku_id, CAST(o_totalprice AS DECIMAL(18,2)) AS order_amount,
       o_orderdate + INTERVAL '1' HOUR AS pay_time, o_orderdate + INTERVAL '1' DAY AS commit_ship_time,
       CASE o_orderkey % 6 WHEN 0 THEN 'completed' WHEN 1 THEN 'cancelled' WHEN 2 THEN 'refunded' WHEN 3 THEN 'pending' WHEN 4 THEN 'shipped' ELSE 'returned' END AS order_status,
       o_orderdate AS create_time, 'mysql' AS data_source, o_orderdate + INTERVAL '2' DAY AS sync_time FROM {orders}"""
VIEWS["ods_rf_refund"] = """
SELECT concat('r', o_orderkey, '-', 1) AS refund_id, o_orderkey AS order_id, o_custkey AS user_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.50 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS refund_amount,
       o_orderpriority AS refund_status, o_orderdate + INTERVAL '3' DAY AS refund_apply_time, 'changed mind' AS user_input_reason,
       o_orderdate + INTERVAL '5' DAY AS refund_finish_time, 'mysql' AS data_source, o_orderdate + INTERVAL '6' DAY AS sync_time FROM {orders} WHERE o_orderkey % 3 = 0
UNION ALL
SELECT concat('r', o_orderkey, '-', 2), o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.20 AS DECIMAL(4,2)) AS DECIMAL(18,2)),
       o_orderpriority, o_orderdate + INTERVAL '4' DAY, 'late', o_orderdate + INTERVAL '7' DAY, 'mysql', o_orderdate + INTERVAL '8' DAY FROM {orders} WHERE o_orderkey % 12 = 0"""
VIEWS["ods_rf_logistics"] = f"""
SELECT {LINE_ID} AS logistics_id, l_orderkey AS order_id, concat('node', l_linenumber) AS logistics_node, l_shipdate AS node_time,
       concat('carrier', l_suppkey % 10) AS express_company, concat('line ', l_linenumber) AS logistics_desc, 'mysql' AS data_source,
       l_shipdate + INTERVAL '1' DAY AS sync_time FROM {{lineitem}}"""
VIEWS["ods_rf_behavior"] = """
SELECT event_id AS behavior_id, user_id, event_type AS behavior_type, ts AS behavior_time, concat('/page/', event_id % 50) AS page_url,
       'app' AS data_source, ts AS sync_time FROM {events}"""

# ---- change stream --------------------------------------------------------------------------------
# One view per captured table.  Columns named before_* go to the old row; op and ts_ms to the envelope.
TS_MS = "EPOCH_MS(CAST(ts AS TIMESTAMP))"
TS_TEXT = "substr(CAST(CAST(ts AS TIMESTAMP) AS STRING), 1, 19)"
CDC_TABLES = (
    "order_info order_detail order_detail_activity order_detail_coupon payment_info order_refund_info refund_payment cart_info comment_info"
).split()

VIEWS["v_purchase"] = f"""
SELECT event_id, user_id, ts, k, {TS_MS} AS ts_ms, {TS_TEXT} AS ts_text, CAST(value AS DECIMAL(16,2)) AS price
FROM {{v_event}} WHERE event_type = 'purchase'"""
_ORDER = "event_id AS id, user_id, user_id % 25 AS province_id"
VIEWS["v_cdc_order_info"] = f"""
SELECT 'c' AS op, {_ORDER}, '1001' AS order_status, ts_text AS operate_time, CAST(NULL AS STRING) AS before_order_status, ts_ms FROM {{v_purchase}}
UNION ALL SELECT 'u', {_ORDER}, '1003', ts_text, '1001', ts_ms + 600000 FROM {{v_purchase}} WHERE k % 10 = 1
UNION ALL SELECT 'u', {_ORDER}, '1005', ts_text, '1002', ts_ms + 3600000 FROM {{v_purchase}} WHERE k % 5 = 0
UNION ALL SELECT 'u', {_ORDER}, '1006', ts_text, '1005', ts_ms + 7200000 FROM {{v_purchase}} WHERE k % 10 = 0"""
VIEWS["v_cdc_order_detail"] = """
SELECT 'c' AS op, concat(event_id, '-1') AS id, event_id AS order_id, event_id % 200 AS sku_id, concat('sku-', event_id % 200) AS sku_name,
       ts_ms AS create_time, k % 6 AS source_id, concat('240', k % 4) AS source_type, k % 5 + 1 AS sku_num, price AS order_price,
       CAST(price * (k % 5 + 1) AS DECIMAL(16,2)) AS split_total_amount, CAST(price * (k % 3) AS DECIMAL(16,2)) AS split_activity_amount,
       CAST(k % 7 AS DECIMAL(16,2)) AS split_coupon_amount, ts_ms FROM {v_purchase}
UNION ALL
SELECT 'c', concat(event_id, '-2'), event_id, (event_id + 7) % 200, concat('sku-', (event_id + 7) % 200), ts_ms, 1, '2401', 2, price,
       CAST(price * 2 AS DECIMAL(16,2)), CAST(0 AS DECIMAL(16,2)), CAST(0 AS DECIMAL(16,2)), ts_ms FROM {v_purchase} WHERE k % 4 = 0"""
VIEWS["v_cdc_order_detail_activity"] = """
SELECT 'c' AS op, event_id AS id, concat(event_id, '-1') AS order_detail_id, k % 12 AS activity_id, k % 24 AS activity_rule_id, ts_ms FROM {v_purchase} WHERE k % 2 = 0"""
VIEWS["v_cdc_order_detail_coupon"] = """
SELECT 'c' AS op, event_id AS id, concat(event_id, '-1') AS order_detail_id, k % 30 AS coupon_id, ts_ms FROM {v_purchase} WHERE k % 3 = 0"""
VIEWS["v_cdc_payment_info"] = """
SELECT 'u' AS op, event_id AS id, user_id, event_id AS order_id, concat('110', k % 5 + 1) AS payment_type, ts_text AS callback_time,
       CASE WHEN k % 3 = 0 THEN '1601' ELSE '1602' END AS payment_status, '1601' AS before_payment_status, ts_ms + k * 40000 AS ts_ms FROM {v_purchase}"""
_REFUND = "event_id AS id, user_id, event_id AS order_id, event_id % 200 AS sku_id, concat('150', k % 3 + 1) AS refund_type, k % 5 + 1 AS refund_num, price AS refund_amount, concat('130', k % 4 + 1) AS refund_reason_type, 'not as shown' AS refund_reason_txt, ts_text AS create_time"
VIEWS["v_cdc_order_refund_info"] = f"""
SELECT 'c' AS op, {_REFUND}, '0701' AS refund_status, CAST(NULL AS STRING) AS before_refund_status, ts_ms + 3700000 AS ts_ms FROM {{v_purchase}} WHERE k % 5 = 0
UNION ALL SELECT 'u', {_REFUND}, '0705', '0701', ts_ms + 5000000 FROM {{v_purchase}} WHERE k % 10 = 0"""
VIEWS["v_cdc_refund_payment"] = """
SELECT 'u' AS op, event_id AS id, event_id AS order_id, event_id % 200 AS sku_id, concat('110', k % 5 + 1) AS payment_type, ts_text AS callback_time,
       price AS total_amount, '1602' AS refund_status, '1601' AS before_refund_status, ts_ms + 7300000 AS ts_ms FROM {v_purchase} WHERE k % 10 = 0"""
VIEWS["v_cdc_cart_info"] = f"""
SELECT CASE {K} % 4 WHEN 0 THEN 'r' WHEN 1 THEN 'c' ELSE 'u' END AS op, event_id AS id, user_id, event_id % 200 AS sku_id, {K} % 5 + 2 AS sku_num,
       CASE {K} % 4 WHEN 2 THEN 1 WHEN 3 THEN 9 END AS before_sku_num, {TS_MS} AS ts_ms FROM {{v_event}} WHERE event_type = 'click'"""
VIEWS["v_cdc_comment_info"] = f"""
SELECT 'c' AS op, event_id AS id, user_id, event_id % 200 AS sku_id, concat('120', {K} % 6 + 1) AS appraise, concat('text ', {K}) AS comment_txt,
       {TS_MS} AS ts_ms FROM {{v_event}} WHERE event_type = 'view'"""
VIEWS["ods_dim_config"] = """
SELECT 'comment_info' AS source_table, 'dim_comment' AS sink_table, 'id,user_id,appraise' AS sink_columns, 'id' AS sink_row_key
UNION ALL SELECT 'order_info', 'dim_order_state', 'id,order_status', 'id'"""
VIEWS["v_rf_log"] = f"""
SELECT event_id, CASE event_type WHEN 'click' THEN 'user' WHEN 'purchase' THEN 'order' WHEN 'view' THEN 'product' ELSE 'other' END AS type,
       event_type = 'error' AND {K} % 10 = 7 AS broken FROM {{v_event}}"""


def references(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def spark_text(text: str) -> str:
    return text.replace("EPOCH_MS(", "unix_millis(").replace("JSON_TEXT(", "get_json_object(")


def view(spark: SparkSession, name: str, table: Callable[[str], DataFrame]) -> DataFrame:
    text = VIEWS[name]
    return spark.sql(spark_text(text), **{t: table(t) for t in references(text)})


# ---- nested and JSON forms -------------------------------------------------------------------------
INPUTS: dict[str, Callable[..., DataFrame]] = {}


def _input(fn):
    INPUTS[fn.__name__] = fn
    return fn


def _once(text, name: str):
    """The text as a column of its own.  Without this the optimiser would copy the
    expression that builds a text into every expression that later reads it."""
    return F.explode(F.array(text)).alias(name)


@_input
def ods_log(v_log):
    """Click log, one JSON text per line."""
    common = F.struct(
        F.col("ar").cast("string").alias("ar"), "ba", "ch", "is_new", "md", "mid", "os",
        F.col("uid").cast("string").alias("uid"), "vc", "sid",
    )
    page = F.when(
        F.col("page_id").isNotNull(),
        F.struct("item", "item_type", "last_page_id", "page_id", "from_pos_id", "from_pos_seq", "refer_id", "during_time"),
    )
    err = F.when(F.col("event_type") == "error", F.struct(F.lit(1000).alias("error_code"), F.lit("failed").alias("msg")))
    start = F.when((F.col("event_type") == "error") & (F.col("k") % 2 == 0), F.struct(F.lit("icon").alias("entry"), F.col("during_time").alias("loading_time")))
    seen = F.when(F.col("event_type") == "view", F.transform(
        F.sequence(F.lit(1), F.col("k") % 3 + 1),
        lambda i: F.struct(F.concat(F.lit("d"), i).alias("item"), i.alias("pos_seq")),
    ))
    done = F.when(F.col("event_type") == "click", F.array(F.struct(F.lit("cart_add").alias("action_id"), F.col("item").alias("item"))))
    text = F.to_json(F.struct(
        common.alias("common"), page.alias("page"), err.alias("err"), start.alias("start"),
        seen.alias("displays"), done.alias("actions"), F.col("ts_ms").alias("ts"),
    ))
    broken = F.when((F.col("event_type") == "error") & (F.col("k") % 10 == 7), F.lit("{broken")).otherwise(text)
    return v_log.select(_once(broken, "log"))


@_input
def ods01_page_log(v01_page):
    return v01_page.select(
        F.struct(F.lit(None).cast("string").alias("ar"), "ba", "ch", F.lit("0").alias("is_new"), "mid", F.col("user_id").alias("uid")).alias("common"),
        F.struct("during_time", F.col("sku_id").alias("item"), F.lit("sku_id").alias("item_type"), "last_page_id", "page_id", "source_type").alias("page"),
        "ts", "dt",
    )


@_input
def ods01_cart_add(v01_cart):
    return v01_cart.select("type", "ts", "dt", F.struct("user_id", "sku_id", "create_time", "source_type", "source_id", "sku_num").alias("data"))


@_input
def ods01_order_detail(v01_order):
    return v01_order.select("type", "ts", "dt", F.struct(
        "user_id", "order_id", "sku_id", "create_time", "source_type", "source_id", "sku_num", "split_total_amount").alias("data"))


@_input
def ods01_payment_info(v01_payment):
    return v01_payment.select("type", "ts", "dt", F.struct("user_id", "order_id", "total_amount", "payment_time").alias("data"))


@_input
def ods01_sku_info(v01_sku):
    return v01_sku


def _envelope(df: DataFrame, table: str) -> DataFrame:
    """Change rows as envelope text; values are text, as a change stream sends them."""
    columns = df.columns
    old = [c for c in columns if c.startswith("before_")]
    new = [c for c in columns if c not in ("op", "ts_ms", *old)]

    def as_map(pairs):
        return "map(" + ", ".join(f"'{name}', CAST({c} AS STRING)" for name, c in pairs) + ")"

    before = "CAST(NULL AS MAP<STRING,STRING>)"
    if old:
        before = f"CASE WHEN op = 'u' THEN {as_map([('id', 'id')] + [(c.removeprefix('before_'), c) for c in old])} END"
    after, source = as_map([(c, c) for c in new]), f"map('db', 'retail', 'table', '{table}')"
    text = f"to_json(named_struct('op', op, 'before', {before}, 'after', {after}, 'source', {source}, 'ts_ms', ts_ms))"
    return df.selectExpr(f"explode(array({text})) AS value", f"'{table}' AS source_table")


@_input
def ods_cdc(v_cdc_order_info, v_cdc_order_detail, v_cdc_order_detail_activity, v_cdc_order_detail_coupon, v_cdc_payment_info,
            v_cdc_order_refund_info, v_cdc_refund_payment, v_cdc_cart_info, v_cdc_comment_info):
    """The change topic: every captured table in one stream of JSON texts."""
    tables = [v_cdc_order_info, v_cdc_order_detail, v_cdc_order_detail_activity, v_cdc_order_detail_coupon, v_cdc_payment_info,
              v_cdc_order_refund_info, v_cdc_refund_payment, v_cdc_cart_info, v_cdc_comment_info]
    out = _envelope(tables[0], CDC_TABLES[0])
    for df, name in zip(tables[1:], CDC_TABLES[1:]):
        out = out.unionByName(_envelope(df, name))
    return out


@_input
def ods_rf_log(v_rf_log):
    text = F.to_json(F.struct("type", "event_id"))
    return v_rf_log.select(_once(F.when(F.col("broken"), F.concat(F.lit("{broken "), "event_id")).otherwise(text), "value"))


def warehouse(spark: SparkSession, folder: str, as_of="2001-08-01", log_as_of="2024-01-30", **options):
    """A warehouse whose source tables come from the supplied parquet files."""
    from stratamart.warehouse import Warehouse

    box: list[Warehouse] = []

    def read(name: str) -> DataFrame:
        if name in VIEWS:
            return view(spark, name, box[0].table)
        return spark.read.parquet(f"{folder}/{name}.parquet")

    box.append(Warehouse(read, as_of, log_as_of, inputs=INPUTS, **options))
    return box[0]

"""Product macro report, product 360 and new users."""

SQL: dict[str, str] = {}

SQL["dwd01_page_log"] = "SELECT user_id, sku_id, page_id, last_page_id, during_time, source_type, ts, dt FROM {v01_page} WHERE page_id IS NOT NULL"
SQL["dwd01_cart_add"] = """
SELECT user_id, sku_id, CAST(create_time AS DATE) AS date_id, create_time, source_type, source_id, sku_num, ts, dt FROM {v01_cart} WHERE type = 'insert'"""
SQL["dwd01_order_detail"] = """
SELECT user_id, order_id, sku_id, CAST(create_time AS DATE) AS date_id, create_time, source_type, source_id, sku_num, split_total_amount, ts, dt
FROM {v01_order} WHERE type = 'insert'"""
SQL["dwd01_pay_suc"] = """
SELECT p.user_id, p.order_id, coalesce(o.sku_id, 'UNKNOWN') AS sku_id, CAST(p.payment_time AS DATE) AS date_id, p.payment_time,
       coalesce(o.sku_num, 0) AS sku_num, p.total_amount AS split_payment_amount, p.ts, p.dt
FROM {v01_payment} p LEFT JOIN {v01_order} o ON o.order_id = p.order_id AND o.dt = p.dt AND o.type = 'insert' WHERE p.type = 'insert'"""
SQL["dws01_product_view_1d"] = """
SELECT sku_id, dt, count(*) AS view_count_1d, count(DISTINCT user_id) AS view_user_count_1d, CAST(floor(avg(during_time)) AS BIGINT) AS avg_stay_time_1d
FROM {dwd01_page_log} WHERE page_id = 'good_detail' GROUP BY ALL"""
SQL["dws01_product_cart_1d"] = """
SELECT sku_id, dt, count(*) AS cart_add_count_1d, count(DISTINCT user_id) AS cart_add_user_count_1d, sum(sku_num) AS cart_add_num_1d FROM {dwd01_cart_add} GROUP BY ALL"""
SQL["dws01_product_order_1d"] = """
SELECT sku_id, dt, count(*) AS order_count_1d, count(DISTINCT user_id) AS order_user_count_1d, sum(sku_num) AS order_num_1d,
       sum(split_total_amount) AS order_amount_1d FROM {dwd01_order_detail} GROUP BY ALL"""
SQL["dws01_product_payment_1d"] = """
SELECT sku_id, dt, count(*) AS payment_count_1d, count(DISTINCT user_id) AS payment_user_count_1d, sum(sku_num) AS payment_num_1d,
       sum(split_payment_amount) AS payment_amount_1d FROM {dwd01_pay_suc} GROUP BY ALL"""
SQL["ads01_product_efficiency"] = """
SELECT dt, product_visitor_count, product_view_count, visited_product_count, avg_stay_time, cart_add_num, cart_add_user_count,
       RATE(cart_add_user_count, nullif(product_visitor_count, 0), 4) AS cart_conversion_rate, order_user_count, order_num, order_amount,
       RATE(order_user_count, nullif(product_visitor_count, 0), 4) AS order_conversion_rate, payment_user_count, payment_num, payment_amount,
       paid_product_count, RATE(payment_user_count, nullif(product_visitor_count, 0), 4) AS payment_conversion_rate,
       RATE(payment_amount, nullif(payment_user_count, 0), 2) AS customer_price,
       isoyear(dt) || '-' || lpad(CAST(weekofyear(dt) AS VARCHAR), 2, '0') AS stat_week, strftime(dt, '%Y-%m') AS stat_month, year(dt) AS stat_year
FROM (SELECT dt, sum(view_user_count_1d) AS product_visitor_count, sum(view_count_1d) AS product_view_count, count(*) FILTER (WHERE view_count_1d > 0) AS visited_product_count,
             RATE(sum(avg_stay_time_1d), count(avg_stay_time_1d) * 1000, 2) AS avg_stay_time, sum(cart_add_num_1d) AS cart_add_num, sum(cart_add_user_count_1d) AS cart_add_user_count,
             sum(order_user_count_1d) AS order_user_count, sum(order_num_1d) AS order_num, sum(order_amount_1d) AS order_amount,
             sum(payment_user_count_1d) AS payment_user_count, sum(payment_num_1d) AS payment_num, sum(payment_amount_1d) AS payment_amount,
             count(*) FILTER (WHERE payment_amount_1d > 0) AS paid_product_count
      FROM {dws01_product_view_1d} FULL JOIN {dws01_product_cart_1d} USING (sku_id, dt) FULL JOIN {dws01_product_order_1d} USING (sku_id, dt)
      FULL JOIN {dws01_product_payment_1d} USING (sku_id, dt) GROUP BY dt)"""


def _bands(column, bounds, top):
    arms = " ".join(f"WHEN {column} <= {upper} THEN '{label}'" for upper, label in bounds)
    return f"CASE WHEN {column} IS NULL THEN '其他' {arms} ELSE '{top}' END"


_N = [(50, "0-50"), (100, "51-100"), (150, "101-150"), (300, "151-300")]
_A = [(1000, "0-1000"), (5000, "1001-5000"), (10000, "5001-10000"), (50000, "10001-50000")]
_PAID = "(SELECT * FROM {dws01_product_payment_1d} WHERE dt = :log_as_of)"
_SUMS = "sum({a}) AS payment_amount, sum({n}) AS payment_num, RATE(sum({a}), nullif(sum({n}), 0), 2) AS avg_price"
_P = _SUMS.format(a="payment_amount_1d", n="payment_num_1d")
SQL["ads01_range_analysis"] = f"""
SELECT :log_as_of AS stat_date, 'price_range' AS range_type, {_bands("s.price", _N, "300+")} AS range_value, count(DISTINCT s.id) AS active_product_count,
       {_SUMS.format(a="coalesce(p.payment_amount_1d, 0)", n="coalesce(p.payment_num_1d, 0)")}
FROM {{v01_sku}} s LEFT JOIN {_PAID} p ON p.sku_id = s.id GROUP BY ALL
UNION ALL SELECT :log_as_of, 'payment_num_range', {_bands("payment_num_1d", _N, "300+")} AS range_value, count(DISTINCT sku_id), {_P} FROM {_PAID} GROUP BY range_value
UNION ALL SELECT :log_as_of, 'payment_amount_range', {_bands("payment_amount_1d", _A, "50000+")} AS range_value, count(DISTINCT sku_id), {_P} FROM {_PAID} GROUP BY range_value"""

SQL["dwd03_product"] = "SELECT item_id, item_name, category_id, brand_id, create_time, is_deleted FROM {ods03_product_info} WHERE item_id IS NOT NULL"
SQL["dwd03_sku"] = "SELECT sku_id, item_id, spec, stock, sku_price, create_time FROM {ods03_sku_info} WHERE sku_id IS NOT NULL"
SQL["dwd03_user"] = "SELECT user_id, gender, age, region, register_time FROM {ods03_user_info} WHERE user_id IS NOT NULL"
SQL["dwd03_order_detail"] = """
SELECT order_id, user_id, item_id, sku_id, order_price, quantity, order_status, strftime(order_time, '%Y-%m') AS dt FROM {ods03_order_detail} WHERE order_id IS NOT NULL"""
SQL["dwd03_payment"] = "SELECT payment_id, order_id, pay_amount, pay_channel, strftime(pay_time, '%Y-%m') AS dt FROM {ods03_payment_info} WHERE payment_id IS NOT NULL"
SQL["dwd03_search_log"] = "SELECT search_id, user_id, keyword, strftime(search_time, '%Y-%m') AS dt FROM {ods03_search_log} WHERE search_id IS NOT NULL"
SQL["dwd03_content_log"] = """
SELECT content_id, user_id, item_id, content_type, interaction_type, strftime(interaction_time, '%Y-%m') AS dt FROM {ods03_content_log} WHERE content_id IS NOT NULL"""
SQL["dwd03_comment"] = """
SELECT comment_id, user_id, item_id, sku_id, score, comment_text, strftime(comment_time, '%Y-%m') AS dt FROM {ods03_comment_info} WHERE comment_id IS NOT NULL"""
SQL["dws03_item_order_month"] = """
SELECT item_id, dt, count(DISTINCT user_id) AS order_user_cnt, count(DISTINCT order_id) AS order_cnt, sum(order_price * quantity) AS order_amt
FROM {dwd03_order_detail} GROUP BY ALL"""
SQL["dws03_item_comment_month"] = """
SELECT item_id, dt, count(*) AS comment_cnt, count(*) FILTER (WHERE score >= 4) AS good_cnt, count(*) FILTER (WHERE score <= 2) AS bad_cnt,
       RATE(sum(CAST(score AS DECIMAL(20,2))), count(score), 2) AS avg_score FROM {dwd03_comment} GROUP BY ALL"""
SQL["dws03_item_behavior_month"] = """
SELECT l.item_id, l.dt, l.view_cnt, l.cart_cnt, l.collect_cnt, coalesce(c.comment_cnt, 0) AS comment_cnt, coalesce(c.good_cnt, 0) AS good_cnt,
       coalesce(c.bad_cnt, 0) AS bad_cnt, c.avg_score
FROM (SELECT item_id, dt, count(*) FILTER (WHERE interaction_type = 'view') AS view_cnt, count(*) FILTER (WHERE interaction_type = 'cart') AS cart_cnt,
             count(*) FILTER (WHERE interaction_type = 'collect') AS collect_cnt FROM {dwd03_content_log} GROUP BY ALL) l
LEFT JOIN {dws03_item_comment_month} c USING (item_id, dt)"""
SQL["dws03_item_payment_month"] = """
SELECT o.item_id, o.dt, count(DISTINCT o.user_id) AS pay_user_cnt, count(DISTINCT p.payment_id) AS pay_cnt, sum(p.pay_amount) AS pay_amt
FROM (SELECT DISTINCT order_id, item_id, user_id, dt FROM {dwd03_order_detail}) o JOIN {dwd03_payment} p ON p.order_id = o.order_id AND p.dt = o.dt GROUP BY ALL"""
SQL["dws03_item_conversion_month"] = """
SELECT b.item_id, b.dt, b.view_cnt, p.pay_user_cnt, o.order_user_cnt, RATE(p.pay_user_cnt, nullif(b.view_cnt, 0), 4) AS conversion_rate,
       CAST(0 AS DOUBLE) AS repurchase_rate
FROM {dws03_item_behavior_month} b LEFT JOIN {dws03_item_payment_month} p USING (item_id, dt) LEFT JOIN {dws03_item_order_month} o USING (item_id, dt)"""
SQL["ads03_item_360"] = """
SELECT o.item_id, o.dt, o.order_cnt, o.order_user_cnt, o.order_amt, coalesce(p.pay_cnt, 0) AS pay_cnt, coalesce(p.pay_user_cnt, 0) AS pay_user_cnt,
       coalesce(p.pay_amt, 0) AS pay_amt, coalesce(b.view_cnt, 0) AS view_cnt, coalesce(b.cart_cnt, 0) AS cart_cnt, coalesce(b.collect_cnt, 0) AS collect_cnt,
       CASE WHEN coalesce(b.view_cnt, 0) > 0 THEN RATE(coalesce(p.pay_user_cnt, 0), b.view_cnt, 4) ELSE 0.0 END AS conversion_rate,
       CAST(0 AS DOUBLE) AS repurchase_rate, coalesce(c.comment_cnt, 0) AS comment_cnt, coalesce(c.avg_score, 0) AS avg_score,
       coalesce(d.v, 0) AS content_exp_cnt, coalesce(d.c, 0) AS content_click_cnt, coalesce(s.sku_cnt, 0) AS sku_cnt, coalesce(s.avg_price, 0) AS avg_price
FROM {dws03_item_order_month} o LEFT JOIN {dws03_item_payment_month} p USING (item_id, dt) LEFT JOIN {dws03_item_behavior_month} b USING (item_id, dt)
LEFT JOIN {dws03_item_comment_month} c USING (item_id, dt)
LEFT JOIN (SELECT item_id, dt, count(*) FILTER (WHERE interaction_type = 'view') AS v, count(*) FILTER (WHERE interaction_type = 'click') AS c
           FROM {dwd03_content_log} GROUP BY ALL) d USING (item_id, dt)
LEFT JOIN (SELECT item_id, count(*) AS sku_cnt, RATE(sum(CAST(sku_price AS DECIMAL(16,2))), count(*), 2) AS avg_price FROM {dwd03_sku} GROUP BY item_id) s USING (item_id)"""
SQL["ads_new_old_users"] = """
SELECT login_date, count(DISTINCT user_id) FILTER (WHERE login_date = first_day) AS new_user_count, count(DISTINCT user_id) FILTER (WHERE login_date > first_day) AS old_user_count
FROM (SELECT *, min(login_date) OVER (PARTITION BY user_id) AS first_day FROM {fact_log}) GROUP BY login_date"""

"""Helper statements."""

SQL: dict[str, str] = {}

_B = "lpad(CAST(CAST('0x' || right(md5({c}), 3) AS INT) % 64 AS VARCHAR), 4, '0')"
SQL["fx_hash_bucket"] = f"""
SELECT id, {_B.format(c="name")} AS bucket, CASE name WHEN 'Customer#000000003' THEN '9001' WHEN 'Customer#000000007' THEN '9002' ELSE {_B.format(c="name")} END AS reserved_bucket
FROM {{ods_user_info}}"""
SQL["fx_bucket_load"] = f"SELECT {_B.format(c='CAST(user_id AS VARCHAR)')} AS bucket, count(*) AS orders FROM {{ods_order_info}} GROUP BY bucket"
SQL["fx_order_days"] = """
SELECT id, CAST(strftime(CAST(create_time AS DATE) + n, '%Y%m%d') AS INT) AS day FROM {ods_order_info}, (VALUES (0), (1), (2)) t(n)"""
SQL["fx_hex_words"] = """
SELECT id, 0 AS position, md5(name) || md5(name) AS word FROM {ods_user_info} UNION ALL SELECT id, 1, md5(user_level) || md5(gender) FROM {ods_user_info}"""
# 40 hex digits are hi * 2^80 + lo, and 2^80 is 1208925819614 * 10^12 + 629174706176: no step leaves 128 bits.
_PART = "(CAST('0x' || substr({h}, {a}, 10) AS HUGEINT) * 1099511627776 + CAST('0x' || substr({h}, {b}, 10) AS HUGEINT))"
_HI, _LO = _PART.format(h="h", a=1, b=11), _PART.format(h="h", a=21, b=31)
_LONG = f"""CAST({_HI} * 1208925819614 + ({_HI} * 629174706176 + {_LO}) // 1000000000000 AS VARCHAR)
  || lpad(CAST(({_HI} * 629174706176 + {_LO}) % 1000000000000 AS VARCHAR), 12, '0')"""
_DIGITS = "('f' || md5(CAST(id AS VARCHAR)) || md5(id || 'b'))"
_ID = "id, CAST(original_total_amount * 100 AS DECIMAL(20,0)) AS cents, CAST(original_total_amount AS DECIMAL(20,2)) AS amount"
SQL["fx_amount_text"] = f"""
SELECT id, max(cents) AS cents, max(amount) AS amount, max(value) FILTER (n = 31) AS hex_31, max(value) FILTER (n = 40) AS hex_40,
       CASE WHEN max(cents) = 0 THEN '0' ELSE '0.' || rtrim(lpad(CAST(max(cents) AS VARCHAR), 18, '0'), '0') END AS hex_64
FROM (SELECT id, cents, amount, n, ltrim({_LONG}, '0') AS value FROM (SELECT {_ID}, n, lpad(left({_DIGITS}, n), 40, '0') AS h FROM {{ods_order_info}}, (VALUES (31), (40)) t(n)))
GROUP BY id"""
SQL["fx_json_append"] = """SELECT id, '["' || sku_name || '","' || is_ordered || '","' || user_id || '"]' AS items FROM {ods_cart_info}"""
SQL["fx_allowed_characters"] = """
SELECT id, regexp_full_match(name, '[a-zA-Z0-9_]+') AS name_ok, regexp_full_match(phone_num, '[a-zA-Z0-9_]+') AS phone_ok FROM {ods_user_info}"""
_TOKENS = r"regexp_split_to_array(lower(text), '[^\pL\pN]+')"
SQL["word_check"] = f"""
SELECT c.conv_id, c.turn, count(w.word) AS hits
FROM (SELECT conv_id, turn, unnest(list_distinct({_TOKENS})) AS token FROM {{conversations}} UNION ALL SELECT conv_id, turn, NULL FROM {{conversations}}) c
LEFT JOIN (SELECT DISTINCT word FROM (SELECT unnest({_TOKENS}) AS word FROM {{benchmark}}) WHERE word <> '') w ON w.word = c.token GROUP BY c.conv_id, c.turn"""
SQL["zipper_user"] = """
SELECT id, user_level, '2024-01-01' AS start_date, CASE WHEN id % 3 = 0 THEN '2024-01-29' ELSE '9999-12-31' END AS end_date FROM {ods_user_info} WHERE create_time < :log_as_of
UNION ALL SELECT id, CASE WHEN id % 3 = 0 THEN 'RAISED' ELSE user_level END, '2024-01-30', '9999-12-31' FROM {ods_user_info} WHERE create_time >= :log_as_of OR id % 3 = 0"""
SQL["keyed_latest"] = """
SELECT order_id, order_status, operate_time FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY operate_time DESC) AS rn FROM {ods_order_status_log}) WHERE rn = 1"""
SQL["keys_deleted"] = "SELECT id, user_id, order_status FROM {ods_order_info} WHERE id NOT IN (SELECT order_id FROM {ods_payment_info})"
SQL["report_accumulated"] = "SELECT * FROM {dws_province_order_1d} WHERE dt BETWEEN :as_of - 3 AND :as_of - 1"
SQL["day_buckets"] = """
SELECT CASE WHEN event_type = 'error' AND k % 10 = 7 THEN 'error_bucket' ELSE strftime(ts, '%Y%m%d') END AS day, count(*) AS lines FROM {v_log} GROUP BY ALL"""

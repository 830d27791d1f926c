"""SQL twins of ``millrace.sources.sample``: the derived inputs, written against the test tables."""

from __future__ import annotations


def stamp(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def text(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR)"


def bounds(bucket: str, length: str) -> str:
    """Window bounds as text."""
    return f"{stamp(bucket)} AS stt, {stamp(f'{bucket} + INTERVAL {length}')} AS edt"


_DICTIONARY = """
('1101','alipay'),('1102','wechat'),('1103','unionpay'),
('1301','quality'),('1302','description'),('1303','out of stock'),('1304','number'),
('1305','wrong order'),('1306','unwanted'),('1307','other'),
('1501','refund only'),('1502','return and refund'),
('2401','search'),('2402','promotion'),('2403','recommendation')
"""

INPUTS: dict[str, str] = {}

INPUTS["dic"] = f"SELECT * FROM (VALUES {_DICTIONARY}) AS d(dic_code, dic_name)"

# click log: one row per event
INPUTS["pv"] = f"""
SELECT event_id AS seq, ts, epoch_us(ts) // 1000 AS ts_ms, k, event_type,
  {text('user_id')} AS mid, CASE WHEN k % 5 <> 0 THEN {text('user_id')} END AS uid,
  'v' || (user_id % 4) AS vc, 'ch' || (user_id % 5) AS ch, 'ar' || (user_id % 7) AS ar,
  CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS is_new,
  CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_list' WHEN 'purchase' THEN 'good_detail'
    WHEN 'signup' THEN 'login' ELSE 'error' END AS page_id,
  CASE event_type WHEN 'view' THEN '' WHEN 'signup' THEN '' WHEN 'click' THEN 'search'
    WHEN 'purchase' THEN 'login' END AS last_page_id,
  'keyword' AS item_type, CAST(round(value * 1000) AS BIGINT) AS during_time,
  p_name AS item
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e
LEFT JOIN part ON p_partkey = k"""

INPUTS["lg"] = """
SELECT *, k % 10 = 0 AS is_start, event_type = 'error' AS has_err, k % 4 AS n_displays,
  CASE WHEN k % 3 <> 0 THEN k % 3 END AS n_actions
FROM pv"""

# records of the raw topic that can be read
INPUTS["good_lg"] = "SELECT * FROM lg WHERE seq % 50 NOT IN (7, 11)"

# trade: order lines with their order
INPUTS["ol"] = """
SELECT l.*, o_custkey, o_orderdate, CAST(epoch(o_orderdate) AS BIGINT) AS t0,
  l_orderkey * 10 + l_linenumber AS line_id, CAST(l_extendedprice AS DECIMAL(16,2)) AS price
FROM lineitem l JOIN orders ON l_orderkey = o_orderkey"""

INPUTS["oo"] = "SELECT *, CAST(epoch(o_orderdate) AS BIGINT) AS t0 FROM orders"

INPUTS["cart"] = f"""
SELECT {text('seq')} AS id, mid AS user_id, {text('k')} AS sku_id,
  '240' || (CAST(mid AS BIGINT) % 4 + 1) AS source_type, k % 7 + 1 AS num, seq % 9 AS old_num,
  event_type, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS sec, ts AS sec_at
FROM pv"""

INPUTS["od"] = f"""
SELECT {text('line_id')} AS id, {text('l_orderkey')} AS order_id, {text('l_partkey')} AS sku_id,
  'sku-' || l_partkey AS sku_name, {stamp('o_orderdate')} AS create_time, o_orderdate, {text('l_suppkey')} AS source_id,
  '240' || (l_suppkey % 4 + 1) AS source_type, {text('CAST(l_quantity AS INT)')} AS sku_num,
  {text('CAST(CAST(l_quantity AS INT) AS DECIMAL(16,2)) * price')} AS split_original_amount,
  {text('price')} AS split_total_amount,
  CASE WHEN l_linenumber % 3 <> 0
    THEN {text('CAST(price * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2))')} END AS split_activity_amount,
  CASE WHEN l_linenumber % 2 <> 0
    THEN {text('CAST(price * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,2))')} END AS split_coupon_amount,
  t0 + (l_linenumber - 1) * 200 AS sec_at
FROM ol"""


def _order_event(kind: str, delay: int, status: str, old: str, condition: str) -> str:
    return f"""
SELECT {text('o_orderkey')} AS id, {text('o_custkey')} AS user_id, {text('o_custkey % 25')} AS province_id,
  {stamp(f'o_orderdate + INTERVAL {delay} SECOND')} AS operate_time, '{status}' AS order_status,
  '{kind}' AS kind, {old} AS old_status, t0 + {delay} AS sec_at FROM oo WHERE {condition}"""


INPUTS["oi"] = " UNION ALL ".join(
    [
        _order_event("insert", 0, "1001", "CAST(NULL AS VARCHAR)", "true"),
        _order_event("update", 60, "1003", "'1001'", "o_orderstatus = 'P'"),
        _order_event("update", 60, "1002", "'1001'", "o_orderstatus = 'F'"),
        _order_event("update", 120, "1005", "'1002'", "o_orderkey % 5 = 0"),
        _order_event("update", 180, "1006", "'1005'", "o_orderkey % 10 = 0"),
        _order_event("update", 240, "1003", "CAST(NULL AS VARCHAR)", "o_orderkey % 7 = 0"),
    ]
)

INPUTS["positions"] = "SELECT oo.*, ln, o_orderkey * 10 + ln AS line_id FROM oo, (SELECT unnest(range(1, 8)) AS ln)"

INPUTS["act"] = f"""
SELECT {text('line_id')} AS order_detail_id, {text('o_orderkey % 10')} AS activity_id, {text('ln')} AS activity_rule_id,
  t0 + ln * 5 AS sec_at FROM positions WHERE ln % 3 <> 0"""

INPUTS["cou"] = f"""
SELECT {text('line_id')} AS order_detail_id, {text('o_orderkey % 4')} AS coupon_id,
  t0 + CASE WHEN o_orderkey % 6 = 0 THEN 2000 ELSE 5 END AS sec_at FROM positions WHERE ln % 2 = 1"""

INPUTS["pay"] = f"""
SELECT {text('o_custkey')} AS user_id, {text('o_orderkey')} AS order_id, '110' || (o_orderkey % 4 + 1) AS payment_type,
  {stamp('o_orderdate + INTERVAL 90 SECOND')} AS callback_time,
  CASE WHEN o_orderstatus <> 'O' THEN '1602' ELSE '1601' END AS payment_status,
  CASE WHEN o_orderkey % 8 = 0 THEN 'insert' ELSE 'update' END AS kind, t0 + 90 AS sec_at FROM oo"""

INPUTS["refund_lines"] = "SELECT * FROM ol WHERE l_returnflag = 'R'"

INPUTS["ri"] = f"""
SELECT {text('line_id')} AS id, {text('o_custkey')} AS user_id, {text('l_orderkey')} AS order_id,
  {text('l_partkey')} AS sku_id, '150' || (l_suppkey % 3 + 1) AS refund_type,
  {text('CAST(l_quantity AS INT)')} AS refund_num, {text('price')} AS refund_amount,
  '130' || (l_partkey % 8 + 1) AS refund_reason_type, 'line ' || l_linenumber AS refund_reason_txt,
  {stamp('o_orderdate + INTERVAL 120 SECOND')} AS create_time, o_orderdate,
  t0 + 116 + l_linenumber * 2 AS asked_at, t0 + 200 AS paid_at, l_linenumber <= 5 AS was_moved
FROM refund_lines"""

INPUTS["rp"] = f"""
SELECT {text('line_id')} AS id, {text('l_orderkey')} AS order_id, {text('l_partkey')} AS sku_id,
  '110' || (l_suppkey % 4 + 1) AS payment_type, {stamp('o_orderdate + INTERVAL 210 SECOND')} AS callback_time,
  o_orderdate, {text('price')} AS total_amount,
  CASE WHEN l_linenumber % 4 <> 0 THEN '0701' ELSE '0702' END AS refund_status, t0 + 210 AS sec_at
FROM refund_lines"""

# order lines joined to their order, activity, coupon and source
INPUTS["pre"] = f"""
SELECT od.id, od.order_id, od.sku_id, od.sku_name, {day('od.o_orderdate')} AS date_id, od.create_time, od.source_id,
  od.source_type, od.sku_num, od.split_original_amount, od.split_activity_amount, od.split_coupon_amount,
  od.split_total_amount, {text('od.sec_at')} AS od_ts, oi.user_id, oi.province_id,
  substr(oi.operate_time, 1, 10) AS operate_date_id, oi.operate_time, oi.order_status, oi.kind AS type, oi.old_status,
  {text('oi.sec_at')} AS oi_ts, act.activity_id, act.activity_rule_id, cou.coupon_id, dic.dic_name AS source_type_name
FROM od JOIN oi ON od.order_id = oi.id AND abs(od.sec_at - oi.sec_at) <= 905
LEFT JOIN act ON od.id = act.order_detail_id AND abs(od.sec_at - act.sec_at) <= 905
LEFT JOIN cou ON od.id = cou.order_detail_id AND abs(od.sec_at - cou.sec_at) <= 905
JOIN dic ON od.source_type = dic.dic_code"""

INPUTS["cart_add"] = f"""
SELECT id, user_id, sku_id,
  {text("CASE WHEN event_type = 'view' THEN num ELSE num - old_num END")} AS sku_num,
  source_type AS source_type_code, dic_name AS source_type_name, {text('sec')} AS ts, sec_at
FROM cart JOIN dic ON source_type = dic_code
WHERE event_type = 'view' OR (event_type = 'click' AND num > old_num)"""

# order detail facts: all versions, and the latest of each
INPUTS["fact_versions"] = f"""
SELECT {text('l_orderkey * 10 + l_linenumber')} AS id, {text('l_orderkey')} AS order_id, {text('o_custkey')} AS user_id,
  {text('l_partkey')} AS sku_id, {text('c_nationkey')} AS province_id, o_orderdate AS ts, l_shipdate AS row_op_ts,
  CAST(l_extendedprice AS DECIMAL(16,2)) AS original,
  CASE WHEN l_linenumber % 3 <> 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(16,2))
    * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2)) END AS activity,
  CASE WHEN l_linenumber % 2 <> 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(16,2))
    * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,2)) END AS coupon,
  l_partkey, l_suppkey, l_extendedprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey"""

INPUTS["facts"] = """
SELECT *, original - coalesce(activity, 0) - coalesce(coupon, 0) AS total FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY row_op_ts DESC, l_partkey DESC, l_suppkey DESC,
    l_extendedprice DESC) AS rn FROM fact_versions) WHERE rn = 1"""

INPUTS["province"] = f"SELECT {text('n_nationkey')} AS id, n_name AS name FROM nation WHERE n_nationkey <> 7"

INPUTS["province_window"] = f"""
SELECT {bounds('b', '10 SECOND')}, province_id, coalesce(name, '') AS province_name, order_count, order_amount FROM (
  SELECT time_bucket(INTERVAL '10 seconds', ts) AS b, province_id, count(DISTINCT order_id) AS order_count,
    CAST(sum(total) AS DECIMAL(38,2)) AS order_amount FROM facts GROUP BY ALL) w
LEFT JOIN province ON province_id = province.id"""

# visitors
INPUTS["uv"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid, CAST(ts AS DATE) ORDER BY ts, seq) AS rn
  FROM pv WHERE coalesce(last_page_id, '') = '') WHERE rn = 1"""

INPUTS["nx"] = """
SELECT *, coalesce(last_page_id, '') = '' AS entry, lead(ts) OVER w AS next_ts,
  lead(coalesce(last_page_id, '') = '') OVER w AS next_entry
FROM pv WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)"""

INPUTS["uj"] = "SELECT * FROM nx WHERE entry AND (next_ts IS NULL OR next_ts - ts >= INTERVAL 6 HOUR OR next_entry)"

INPUTS["login_day"] = """
SELECT *, lag(d) OVER (PARTITION BY uid ORDER BY d) AS last_d FROM (
  SELECT uid, CAST(ts AS DATE) AS d, min(ts) AS ts FROM pv
  WHERE coalesce(uid, '') <> '' AND (last_page_id = 'login' OR coalesce(last_page_id, '') = '') GROUP BY ALL)"""

INPUTS["view_window"] = f"""
SELECT {bounds('b', '1 HOUR')}, vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct,
  CAST(sum(pv_n) AS BIGINT) AS pv_ct, CAST(sum(dur) AS BIGINT) AS dur_sum, CAST(sum(uj_n) AS BIGINT) AS uj_ct
FROM (
  SELECT date_trunc('hour', ts) AS b, vc, ch, ar, is_new, 0 AS uv,
    CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS sv, 1 AS pv_n, during_time AS dur, 0 AS uj_n FROM pv
  UNION ALL SELECT date_trunc('hour', ts), vc, ch, ar, is_new, 1, 0, 0, 0, 0 FROM uv
  UNION ALL SELECT date_trunc('hour', ts), vc, ch, ar, is_new, 0, 0, 0, 0, 1 FROM uj)
GROUP BY b, vc, ch, ar, is_new"""

# dimension changes: what the configured tables receive
INPUTS["sku_writes"] = f"""
SELECT {text('p_partkey')} AS id, 1 AS seq, p_name AS sku_name, p_brand AS tm_id, p_type AS category3_id,
  {text('p_size')} AS spu_id FROM part
UNION ALL SELECT {text('p_partkey')}, 3, upper(p_name), NULL, NULL, NULL FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT {text('p_partkey')}, 4, NULL, 'Brand#0', NULL, NULL FROM part WHERE p_partkey % 9 = 0
UNION ALL SELECT {text('p_partkey')}, 5, NULL, NULL, NULL, '0' FROM part WHERE p_partkey % 27 = 0"""

INPUTS["dim_sku"] = f"""
SELECT {text('p_partkey')} AS id, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS sku_name,
  CASE WHEN p_partkey % 9 = 0 THEN 'Brand#0' ELSE p_brand END AS tm_id, p_type AS category3_id,
  CASE WHEN p_partkey % 27 = 0 THEN '0' ELSE {text('p_size')} END AS spu_id FROM part"""

INPUTS["flat_sku"] = f"""
SELECT {text('p_partkey')} AS sku_id, p_name AS sku_name, p_brand AS trademark_id,
  CASE WHEN p_brand <> 'Brand#13' THEN upper(p_brand) END AS trademark_name, p_type AS category3_id,
  lower(p_type) AS category3_name, p_type[1] AS category2_id, 'c2-' || p_type[1] AS category2_name,
  CASE WHEN p_type[1] < 'M' THEN '1' ELSE '2' END AS category1_id,
  'c1-' || CASE WHEN p_type[1] < 'M' THEN '1' ELSE '2' END AS category1_name, {text('p_size')} AS spu_id, 'spu-' || p_size AS spu_name FROM part"""

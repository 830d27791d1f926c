"""End-to-end jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import NOW_MS, check, now_ms, scratch
from checks.inputs import bounds, day, text
from millrace.functions import times
from millrace.functions.values import once

from millrace.plans import ads, dim, dwd, dws
from millrace.sinks.dimensions import DimensionStore
from millrace.sinks.tables import VersionedTable, with_day
from millrace.sources import lookups, sample, topics

HOUR = "1 hour"
SIX_HOURS = 6 * 3600


PRE_PROCESS = ["order_detail", "order_info", "order_detail_activity", "order_detail_coupon"]


def province_summary(spark, folder, versions: bool = False, date: int | None = None):
    """The summary, of all days or computed for one alone; with ``versions`` also an older state of each row."""
    rows = facts(spark, folder)
    rows = rows if date is None else ads.rows_of_day(rows, date)
    rows = dws.province_orders(rows, sample.provinces(spark, folder), now=now_ms())
    if not versions:
        return with_day(rows)
    return with_day(older(rows).unionByName(rows))


def older(rows):
    changed = rows.withColumns({"order_amount": F.col("order_amount") * 0 + 1, "ts": F.col("ts") - 1})
    return changed.withColumn("order_amount", F.col("order_amount").cast("decimal(38,2)"))


def stored(spark, name: str, *batches) -> VersionedTable:
    """A summary table that was written batch by batch."""
    table = VersionedTable.summary(scratch(spark), name)
    for number, batch in enumerate(batches):
        table.append(batch, number)
    return table


def facts(spark, folder):
    return sample.order_facts(spark, folder).withColumn("rowtime", F.timestamp_seconds("ts"))


def carts(spark, folder):
    rows = dwd.cart_adds(sample.cart_info(spark, folder), lookups.dictionary(spark))
    return topics.trade_time(rows)


def page_view_summary(spark, folder, length: str = HOUR, date: int | None = None):
    pages = sample.page_log(spark, folder)
    if date is not None:
        # a bounce of the day is judged by what follows it, maybe on the next day
        pages = ads.rows_of_day(pages, date, follow_seconds=SIX_HOURS)
    return dws.page_views(pages, dwd.unique_visitors(pages), dwd.user_jumps(pages, SIX_HOURS), length, now_ms())


def flat_page(df, *more):
    return df.select("seq", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts", *more)


DIMENSION_CELLS = f"""
SELECT 'dim_sku_info' AS sink_table, id AS pk, unnest(['id','sku_name','tm_id','category3_id','spu_id']) AS "column",
  unnest([id, sku_name, tm_id, category3_id, spu_id]) AS value FROM dim_sku
UNION ALL SELECT 'dim_base_province', {text('n_nationkey')}, unnest(['id','name','region_id']),
  unnest([{text('n_nationkey')}, n_name, {text('n_regionkey')}]) FROM nation
UNION ALL SELECT 'dim_base_trademark', p_brand, unnest(['id','tm_name']), unnest([p_brand, upper(p_brand)])
  FROM (SELECT DISTINCT p_brand FROM part)"""


def written_dimensions(spark, folder, database: str = "default", ddl: bool = False, snapshot: bool = False) -> DimensionStore:
    """The dimension job over two micro-batches, with a snapshot of the products between them or not."""
    path = scratch(spark)
    store, log = DimensionStore(path), sample.dimension_log(spark, folder)
    run = dim.upsert_batch(sample.config_changes, path, database, ddl)
    run(log.where("seq <= 3"), 0)
    if snapshot:
        store.snapshot(spark, "dim_sku_info", "id", SKU_COLUMNS)
    run(log.where("seq > 3"), 1)
    return store


SKU_COLUMNS = ["id", "sku_name", "tm_id", "category3_id", "spu_id"]


@check("q1_dimension_tables", DIMENSION_CELLS)
def _(spark, folder):
    return dim.dimension_cells(sample.dimension_log(spark, folder), sample.config_changes(spark))


@check(
    "q2_log_split",
    """
SELECT topic, seq, mid, CASE WHEN is_new = '1' AND CAST(ts AS DATE) <> origin THEN '0' ELSE is_new END AS is_new,
  ts_ms AS ts, item FROM (
  SELECT lg.seq, lg.mid, lg.is_new, lg.ts, lg.ts_ms, has_err, is_start, n_displays, n_actions, first_value(
      CASE WHEN is_new = '1' THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END)
    OVER (PARTITION BY mid ORDER BY ts, seq) AS origin FROM good_lg lg) f,
  LATERAL (
    SELECT 'dwd_traffic_err_log' AS topic, CAST(NULL AS VARCHAR) AS item WHERE has_err
    UNION ALL SELECT 'dwd_traffic_start_log', NULL WHERE is_start
    UNION ALL SELECT 'dwd_traffic_page_log', NULL WHERE NOT is_start
    UNION ALL SELECT 'dwd_traffic_display_log', 'd' || i FROM range(1, 4) r(i) WHERE NOT is_start AND i <= n_displays
    UNION ALL SELECT 'dwd_traffic_action_log', 'a' || i FROM range(1, 3) r(i) WHERE NOT is_start AND i <= n_actions)
UNION ALL SELECT 'dirty_data', seq, NULL, NULL, NULL, NULL FROM lg WHERE seq % 50 = 7""",
)
def _(spark, folder):
    messages = dwd.log_messages(sample.traffic_topic(spark, folder), scratch(spark))
    seen = "common struct<mid:string,is_new:string>, ts long, display map<string,string>, action map<string,string>"
    rows = once(messages, ["topic", "seq"], r=F.when(F.col("topic") != "dirty_data", F.from_json("value", seen)))
    item = F.coalesce(F.col("r.display")["item"], F.col("r.action")["item"]).alias("item")
    return rows.select("topic", "seq", "r.common.mid", "r.common.is_new", "r.ts", item)


@check("q3_unique_visitors", "SELECT seq, mid, page_id, ts_ms AS ts, vc FROM uv")
def _(spark, folder):
    return flat_page(dwd.unique_visitors(sample.page_log(spark, folder)), F.col("common.vc").alias("vc"))


@check("q4_user_jumps", "SELECT seq, mid, page_id, ts_ms AS ts, vc FROM uj")
def _(spark, folder):
    return flat_page(dwd.user_jumps(sample.page_log(spark, folder), SIX_HOURS), F.col("common.vc").alias("vc"))


@check("q5_cart_adds", "SELECT id, user_id, sku_id, sku_num, source_type_code, source_type_name, ts FROM cart_add")
def _(spark, folder):
    return dwd.cart_adds(sample.change_log(spark, folder, "cart_info"), lookups.dictionary(spark))


@check("q6_order_pre_process", "SELECT * FROM pre")
def _(spark, folder):
    pre = pre_processed(spark, folder)
    return pre.withColumn("old_status", F.col("old")["order_status"]).drop("old", "row_op_ts")


_DETAIL = """id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
  source_id, source_type AS source_type_code, source_type_name, sku_num, split_original_amount,
  split_activity_amount, split_coupon_amount, split_total_amount"""


def pre_processed(spark, folder):
    return dwd.order_pre_process(sample.change_log(spark, folder, *PRE_PROCESS), lookups.dictionary(spark))


@check("q7_order_details", f"SELECT {_DETAIL}, date_id, create_time, od_ts AS ts FROM pre WHERE type = 'insert'")
def _(spark, folder):
    return dwd.order_details(pre_processed(spark, folder)).drop("row_op_ts")


@check(
    "q8_order_cancels",
    f"""SELECT {_DETAIL}, operate_date_id AS date_id, operate_time AS cancel_time, oi_ts AS ts FROM pre
WHERE type = 'update' AND old_status IS NOT NULL AND order_status = '1003'""",
)
def _(spark, folder):
    return dwd.order_cancels(pre_processed(spark, folder)).drop("row_op_ts")


@check(
    "q9_payments",
    f"""
SELECT pre.id AS order_detail_id, pre.order_id, pre.user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id,
  coupon_id, payment_type AS payment_type_code, dic.dic_name AS payment_type_name, callback_time, source_id,
  source_type AS source_type_code, source_type_name, sku_num, split_original_amount, split_activity_amount,
  split_coupon_amount, split_total_amount AS split_payment_amount, {text('pay.sec_at')} AS ts
FROM pre JOIN pay ON pre.order_id = pay.order_id AND pay.kind = 'update' AND payment_status = '1602'
JOIN dic ON payment_type = dic_code WHERE pre.type = 'insert'""",
)
def _(spark, folder):
    changes, dic = sample.change_log(spark, folder, "payment_info"), lookups.dictionary(spark)
    details = dwd.order_details(pre_processed(spark, folder))
    details = details.withColumn("event_time", times.from_seconds("ts"))
    return dwd.payments(details, changes, dic).drop("row_op_ts")


@check(
    "q10_order_refunds",
    f"""
SELECT ri.id, ri.user_id, ri.order_id, ri.sku_id, oi.province_id, {day('ri.o_orderdate')} AS date_id, ri.create_time,
  refund_type AS refund_type_code, t.dic_name AS refund_type_name, refund_reason_type AS refund_reason_type_code,
  r.dic_name AS refund_reason_type_name, refund_reason_txt, refund_num, refund_amount, {text('asked_at')} AS ts
FROM ri JOIN oi ON ri.order_id = oi.id AND kind = 'update' AND order_status = '1005' AND old_status IS NOT NULL
  AND abs(asked_at - oi.sec_at) <= 5
JOIN dic t ON refund_type = t.dic_code JOIN dic r ON refund_reason_type = r.dic_code""",
)
def _(spark, folder):
    return dwd.order_refunds(sample.change_log(spark, folder, "order_refund_info", "order_info"), lookups.dictionary(spark)).drop("row_op_ts")


@check(
    "q11_refund_payments",
    f"""
SELECT rp.id, oi.user_id, rp.order_id, rp.sku_id, oi.province_id, payment_type AS payment_type_code,
  dic_name AS payment_type_name, {day('rp.o_orderdate')} AS date_id, rp.callback_time, ri.refund_num, rp.total_amount,
  {text('rp.sec_at')} AS ts
FROM rp JOIN oi ON rp.order_id = oi.id AND kind = 'update' AND order_status = '1006' AND old_status IS NOT NULL
JOIN ri ON rp.order_id = ri.order_id AND rp.sku_id = ri.sku_id AND ri.was_moved
JOIN dic ON payment_type = dic_code WHERE rp.refund_status = '0701'""",
)
def _(spark, folder):
    changes = sample.change_log(spark, folder, "refund_payment", "order_info", "order_refund_info")
    return dwd.refund_payments(changes, lookups.dictionary(spark)).drop("row_op_ts")


@check(
    "q12_keyword_views",
    f"""
SELECT {bounds('b', '10 SECOND')}, 'search' AS source, keyword, count(*) AS keyword_count, {NOW_MS} AS ts FROM (
  SELECT time_bucket(INTERVAL '10 seconds', ts) AS b, unnest(string_split(item, ' ')) AS keyword FROM pv
  WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL) GROUP BY b, keyword""",
)
def _(spark, folder):
    return dws.keyword_views(sample.page_log(spark, folder, items=True), now=now_ms())


@check("q13_page_views", f"SELECT *, {NOW_MS} AS ts FROM view_window")
def _(spark, folder):
    return page_view_summary(spark, folder)


@check(
    "q14_home_detail_views",
    f"""
SELECT {bounds('b', '10 SECOND')}, CAST(sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS BIGINT) AS home_uv_ct,
  CAST(sum(CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END) AS BIGINT) AS good_detail_uv_ct, {NOW_MS} AS ts FROM (
  SELECT page_id, time_bucket(INTERVAL '10 seconds', ts) AS b, row_number() OVER
    (PARTITION BY mid, page_id, CAST(ts AS DATE) ORDER BY ts, seq) AS rn
  FROM pv WHERE page_id IN ('home', 'good_detail')) WHERE rn = 1 GROUP BY b""",
)
def _(spark, folder):
    return dws.home_detail_views(sample.page_log(spark, folder), now=now_ms())


@check(
    "q15_user_logins",
    f"""
SELECT {bounds('b', '1 DAY')}, CAST(sum(CASE WHEN d - last_d >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS back_ct,
  count(*) AS uu_ct, {NOW_MS} AS ts
FROM (SELECT *, date_trunc('day', ts) AS b FROM login_day) GROUP BY b""",
)
def _(spark, folder):
    return dws.user_logins(sample.page_log(spark, folder), "1 day", now_ms(), min_days=3)


@check(
    "q16_cart_users",
    f"""
SELECT {bounds('b', '1 HOUR')}, count(*) AS cart_add_uu_ct, {NOW_MS} AS ts FROM (
  SELECT date_trunc('hour', min(sec_at)) AS b FROM cart_add GROUP BY user_id, CAST(sec_at AS DATE)) GROUP BY b""",
)
def _(spark, folder):
    return dws.cart_users(carts(spark, folder), HOUR, now_ms())


@check(
    "q17_sku_orders",
    f"""
SELECT {bounds('b', '10 SECOND')}, trademark_id, trademark_name, category1_id, category1_name, category2_id, category2_name,
  category3_id, category3_name, w.sku_id, sku_name, spu_id, spu_name, order_uu_count, order_count,
  order_origin_total_amount, order_activity_reduce_amount, order_coupon_reduce_amount, order_amount, {NOW_MS} AS ts
FROM (SELECT time_bucket(INTERVAL '10 seconds', ts) AS b, sku_id, CAST(sum(first) AS BIGINT) AS order_uu_count,
    count(DISTINCT order_id) AS order_count, CAST(sum(original) AS DECIMAL(38,2)) AS order_origin_total_amount,
    CAST(sum(coalesce(activity, 0)) AS DECIMAL(38,2)) AS order_activity_reduce_amount,
    CAST(sum(coalesce(coupon, 0)) AS DECIMAL(38,2)) AS order_coupon_reduce_amount,
    CAST(sum(total) AS DECIMAL(38,2)) AS order_amount
  FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, id) = 1
      THEN 1 ELSE 0 END AS first FROM facts) GROUP BY b, sku_id) w
LEFT JOIN flat_sku ON w.sku_id = flat_sku.sku_id""",
)
def _(spark, folder):
    return dws.sku_orders(facts(spark, folder), sample.sku_dims(spark, folder), now=now_ms())


@check("q18_province_orders", f"SELECT *, {NOW_MS} AS ts FROM province_window")
def _(spark, folder):
    return dws.province_orders(facts(spark, folder), sample.provinces(spark, folder), now=now_ms())


@check("q19_gmv", "SELECT CAST(sum(order_amount) AS DECIMAL(38,2)) AS order_amount FROM province_window WHERE stt LIKE '1995-02-18%'")
def _(spark, folder):
    return ads.gmv(province_summary(spark, folder, date=19950218), 19950218)


@check(
    "q20_province_amounts",
    """SELECT province_name, CAST(sum(order_amount) AS DECIMAL(38,2)) AS order_amount FROM province_window
WHERE stt LIKE '1995-02-18%' GROUP BY province_name""",
)
def _(spark, folder):
    return ads.province_amounts(province_summary(spark, folder, versions=True, date=19950218), 19950218)


_CHANNELS = """SELECT ch, CAST(sum(uv_ct) AS BIGINT) AS uv_ct FROM view_window WHERE stt LIKE '2024-01-05%' GROUP BY ch
HAVING sum(uv_ct) > 0 ORDER BY uv_ct DESC, ch LIMIT 3"""


@check("q21_top_channels", _CHANNELS)
def _(spark, folder):
    return ads.top_channels(with_day(page_view_summary(spark, folder, date=20240105)), 20240105, 3)


@check("q22_gmv_today", "SELECT CAST(sum(order_amount) AS DECIMAL(38,2)) AS order_amount FROM province_window WHERE stt LIKE '1995-02-18%'")
def _(spark, folder):
    # the windows of one day are moved to the present one, those of all others stay
    rows = province_summary(spark, folder).drop("dt")
    moved = F.concat(F.date_format(F.current_date(), "yyyy-MM-dd"), F.substring("stt", 11, 9))
    return ads.gmv(rows.withColumn("stt", F.when(F.col("stt").startswith("1995-02-18"), moved).otherwise(F.col("stt"))))


@check(
    "q23_channel_payload",
    f"""SELECT '{{"status":0,"data":[' || string_agg('{{"name":"' || ch || '","value":' || uv_ct || '}}', ',' ORDER BY uv_ct DESC, ch)
  || ']}}' AS payload FROM ({_CHANNELS})""",
)
def _(spark, folder):
    return ads.channel_payload(with_day(page_view_summary(spark, folder, date=20240105)), 20240105, 3)


@check(
    "q23_province_payload",
    """SELECT '{"status":0,"data":{"mapData":[' || string_agg('{"name":"' || province_name || '","value":' || order_amount || '}', ','
  ORDER BY province_name) || '],"valueName":"交易额"}}' AS payload FROM (
  SELECT province_name, CAST(sum(order_amount) AS DECIMAL(38,2)) AS order_amount FROM province_window
  WHERE stt LIKE '1995-02-18%' GROUP BY province_name)""",
)
def _(spark, folder):
    return ads.province_payload(province_summary(spark, folder, date=19950218), 19950218)


@check(
    "q23_gmv_payload",
    """SELECT '{"status":0,"data":' || coalesce(CAST(sum(order_amount) AS DECIMAL(38,2))::VARCHAR, 'null') || '}' AS payload
FROM province_window WHERE stt LIKE '1995-02-18%'""",
)
def _(spark, folder):
    return ads.gmv_payload(province_summary(spark, folder, date=19950218), 19950218)

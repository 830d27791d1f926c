"""Projections, filters and scalar functions."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from checks.base import NOW_MS, check, now_ms
from checks.inputs import day, stamp, text
from checks.jobs import facts, pre_processed
from millrace import schemas
from millrace.functions import cdc, times, values
from millrace.operators import changes as changes_ops
from millrace.operators.routing import display_rows, table_columns
from millrace.operators.unions import measures
from millrace.plans import dim, dwd
from millrace.sources import sample, topics


@check("p1_map_keys_to_columns", "SELECT id, order_id, sku_id, sku_num, split_total_amount, split_coupon_amount FROM od")
def _(spark, folder):
    rows = sample.change_log(spark, folder).where(cdc.routed("order_detail", "insert"))
    return rows.select(*cdc.fields("id", "order_id", "sku_id", "sku_num", "split_total_amount", "split_coupon_amount"))


@check("p2_nested_fields", "SELECT seq, mid, is_new, CASE WHEN NOT is_start THEN last_page_id END AS last_page_id FROM lg")
def _(spark, folder):
    log = sample.traffic_log(spark, folder)
    return log.select("seq", "common.mid", "common.is_new", "page.last_page_id")


@check(
    "p3_configured_keys",
    """SELECT k AS kept, count(*) AS n FROM (
  SELECT CASE WHEN price THEN 'id,sku_name' WHEN tm_id IS NULL AND sku_name IS NULL THEN 'id,spu_id'
    WHEN sku_name IS NULL THEN 'id,tm_id' ELSE 'id,sku_name,tm_id,category3_id,spu_id' END AS k
  FROM (SELECT *, seq = 3 AS price FROM sku_writes)) GROUP BY k""",
)
def _(spark, folder):
    routed = dim.routed(sample.dimension_log(spark, folder), sample.config_changes(spark))
    rows = routed.where(F.col("sink_table") == "dim_sku_info").withColumn("kept", F.concat_ws(",", F.map_keys("data")))
    return rows.groupBy("kept").agg(F.count(F.lit(1)).alias("n"))


@check(
    "p4_row_metadata",
    """SELECT 'dim_sku_info' AS sink_table, CASE seq WHEN 1 THEN 'bootstrap-insert' WHEN 5 THEN 'delete' ELSE 'update' END AS type,
  count(*) AS n FROM sku_writes GROUP BY ALL""",
)
def _(spark, folder):
    routed = dim.routed(sample.dimension_log(spark, folder), sample.config_changes(spark))
    rows = routed.where(F.col("sink_table") == "dim_sku_info")
    assert "type" not in table_columns(routed, "dim_sku_info", ["id"]).columns
    return rows.groupBy("sink_table", "type").agg(F.count(F.lit(1)).alias("n"))


@check(
    "p5_conditional_difference",
    f"""SELECT id, {text("CASE WHEN event_type = 'view' THEN num WHEN event_type = 'click' THEN num - old_num END")} AS sku_num
FROM cart WHERE event_type IN ('view', 'click', 'error')""",
)
def _(spark, folder):
    rows = sample.cart_info(spark, folder).where(
        (F.col("type") == "insert") | ((F.col("type") == "update") & cdc.before("sku_num").isNotNull())
    )
    return rows.select(*cdc.fields("id"), cdc.added("sku_num").alias("sku_num"))


@check("p6_renamed_columns", "SELECT id, order_id, operate_date_id AS date_id, operate_time AS cancel_time, source_type AS source_type_code, oi_ts AS ts FROM pre WHERE order_status = '1003' AND old_status IS NOT NULL")
def _(spark, folder):
    return dwd.order_cancels(pre_processed(spark, folder)).select("id", "order_id", "date_id", "cancel_time", "source_type_code", "ts")


@check("p7_computed_event_time", f"SELECT seq, {stamp('ts')} AS rowtime, 1 AS has_proc_time FROM pv")
def _(spark, folder):
    log = sample.page_log(spark, folder).drop("rowtime")
    rows = topics.with_processing_time(topics.with_event_time(log, times.from_millis_to_second("ts")))
    known = F.when(F.col("proc_time").isNotNull(), 1).otherwise(0).alias("has_proc_time")
    return rows.select("seq", times.second("rowtime").alias("rowtime"), known)


@check("p8_constant_column", "SELECT seq, 'search' AS source FROM pv WHERE last_page_id = 'search'")
def _(spark, folder):
    return sample.page_views(spark, folder).where(F.col("last_page_id") == "search").select("seq", F.lit("search").alias("source"))


@check("p9_rebuilt_objects", "SELECT seq, mid, page_id, ts_ms AS ts, 'd' || i AS item, CAST(i AS VARCHAR) AS pos FROM lg, range(1, 4) r(i) WHERE NOT is_start AND i <= n_displays")
def _(spark, folder):
    rows = display_rows(sample.traffic_log(spark, folder))
    d = F.col("display")
    return rows.select("seq", F.col("common.mid").alias("mid"), "page.page_id", "ts", d["item"].alias("item"), d["order"].alias("pos"))


@check("p10_removed_fields", "SELECT 'seq,rowtime,common,page,ts' AS fields, count(*) AS n FROM lg WHERE NOT is_start")
def _(spark, folder):
    from millrace.operators.routing import page_rows

    rows = page_rows(sample.traffic_log(spark, folder))
    return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(",".join(rows.columns)).alias("fields"), "n")


@check(
    "p11_measure_vector",
    """SELECT seq, vc, ch, CAST(CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS BIGINT) AS sv_ct, CAST(1 AS BIGINT) AS pv_ct,
  during_time AS dur_sum, CAST(0 AS BIGINT) AS uj_ct FROM pv""",
)
def _(spark, folder):
    v = sample.page_views(spark, folder)
    given = {"sv_ct": values.flag(values.is_blank("last_page_id")), "pv_ct": 1, "dur_sum": F.col("during_time")}
    return measures(v, ["seq", "vc", "ch"], ["sv_ct", "pv_ct", "dur_sum", "uj_ct"], given)


@check("p12_null_to_zero", "SELECT id, sku_id, original - total AS reduction, CAST(coalesce(activity, 0) AS DECIMAL(16,2)) AS activity, CAST(coalesce(coupon, 0) AS DECIMAL(16,2)) AS coupon FROM fact_versions".replace("original - total", "CAST(coalesce(activity, 0) + coalesce(coupon, 0) AS DECIMAL(16,2))"))
def _(spark, folder):
    f = facts(spark, folder)
    zero = lambda c: values.or_zero(c).cast(values.MONEY)
    reduction = (F.col("split_original_amount") - F.col("split_total_amount")).cast(values.MONEY)
    return f.select("id", "sku_id", reduction.alias("reduction"), zero("split_activity_amount").alias("activity"), zero("split_coupon_amount").alias("coupon"))


# --- filters -----------------------------------------------------------------------------------------


@check("f1_table_and_type", "SELECT 'order_info' AS \"table\", kind AS type, count(*) AS n FROM oi GROUP BY kind UNION ALL SELECT 'order_detail_coupon', 'insert', count(*) FROM cou")
def _(spark, folder):
    rows = sample.change_log(spark, folder)
    kept = rows.where(cdc.routed("order_info", "insert", "update") | cdc.routed("order_detail_coupon", "insert"))
    return kept.groupBy("table", "type").agg(F.count(F.lit(1)).alias("n"))


@check(
    "f2_clean_changes",
    """SELECT 'sku_info' AS "table", CAST(seq AS BIGINT) AS seq, count(*) AS n FROM sku_writes GROUP BY seq
UNION ALL SELECT 'base_province', 1, count(*) FROM nation UNION ALL SELECT 'base_region', 1, count(*) FROM region
UNION ALL SELECT 'user_info', 1, count(*) FROM customer UNION ALL SELECT 'base_trademark', 1, count(DISTINCT p_brand) FROM part""",
)
def _(spark, folder):
    rows = changes_ops.clean_changes(sample.dimension_log(spark, folder))
    return rows.groupBy("table", "seq").agg(F.count(F.lit(1)).alias("n"))


@check("f3_dirty_records", "SELECT seq, '{\"common\": broken ' || seq AS value FROM lg WHERE seq % 50 = 7")
def _(spark, folder):
    return topics.split_dirty(sample.traffic_topic(spark, folder), schemas.TRAFFIC_LOG)[1]


@check(
    "f4_status_transition",
    """SELECT order_status AS code, count(*) AS n FROM oi WHERE kind = 'update' AND old_status IS NOT NULL
  AND order_status IN ('1003', '1005', '1006') GROUP BY 1
UNION ALL SELECT refund_status, count(*) FROM rp WHERE refund_status = '0701' GROUP BY 1
UNION ALL SELECT '0705', count(*) FROM ri WHERE was_moved""",
)
def _(spark, folder):
    rows = sample.change_log(spark, folder)
    wanted = [("order_info", "order_status", c) for c in (dwd.ORDER_CANCELLED, dwd.ORDER_REFUNDING, dwd.ORDER_REFUNDED)]
    wanted += [("refund_payment", "refund_status", "0701"), ("order_refund_info", "refund_status", "0705")]
    parts = [rows.where(cdc.routed(t) & cdc.transitioned(f, c)).select(cdc.field(f).alias("code")) for t, f, c in wanted]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@check("f5_state_only", "SELECT order_id, payment_type FROM pay WHERE kind = 'update' AND payment_status = '1602'")
def _(spark, folder):
    rows = sample.change_log(spark, folder).where(cdc.routed("payment_info", "update") & (cdc.field("payment_status") == dwd.PAYMENT_DONE))
    return rows.select(*cdc.fields("order_id", "payment_type"))


@check("f6_raised_amount", "SELECT id FROM cart WHERE event_type = 'click' AND num > old_num")
def _(spark, folder):
    return sample.cart_info(spark, folder).where(cdc.grew("sku_num")).select(*cdc.fields("id"))


@check("f7_chosen_pages", "SELECT seq, page_id FROM pv WHERE page_id IN ('home', 'good_detail')")
def _(spark, folder):
    rows = sample.page_log(spark, folder)
    return rows.where(F.col("page.page_id").isin(changes_ops.HOME_PAGE, changes_ops.DETAIL_PAGE)).select("seq", "page.page_id")


@check("f8_logins", "SELECT seq, uid FROM pv WHERE uid IS NOT NULL AND (last_page_id = 'login' OR coalesce(last_page_id, '') = '')")
def _(spark, folder):
    return sample.page_log(spark, folder).where(changes_ops.is_login()).select("seq", "common.uid")


@check("f9_keyword_searches", "SELECT seq, item FROM pv WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL")
def _(spark, folder):
    return sample.page_log(spark, folder, items=True).where(changes_ops.is_keyword_search()).select("seq", "page.item")


@check("f10_entry_pages", "SELECT seq FROM pv WHERE last_page_id IS NULL OR last_page_id = ''")
def _(spark, folder):
    return sample.page_log(spark, folder).where(changes_ops.entry_page()).select("seq")


@check("f11_presence_routing", "SELECT CASE WHEN has_err THEN 1 ELSE 0 END AS err, CASE WHEN is_start THEN 1 ELSE 0 END AS start, CASE WHEN is_start THEN 0 ELSE 1 END AS page, count(*) AS n FROM lg GROUP BY ALL")
def _(spark, folder):
    has = lambda c: F.when(F.col(c).isNotNull(), 1).otherwise(0).alias(c)
    return sample.traffic_log(spark, folder).groupBy(has("err"), has("start"), has("page")).agg(F.count(F.lit(1)).alias("n"))


@check("f12_new_orders", "SELECT od.id, order_id FROM od JOIN oi ON order_id = oi.id JOIN dic ON od.source_type = dic_code WHERE kind = 'insert' AND abs(od.sec_at - oi.sec_at) <= 905")
def _(spark, folder):
    return dwd.order_details(pre_processed(spark, folder)).select("id", "order_id")


@check("f13_day_filter", "SELECT event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-09'")
def _(spark, folder):
    events = sample.table(spark, folder, "events")
    return events.where(times.day_number("ts") == 20240109).select("event_id")


@check("f14_having", "SELECT ch, count(*) AS uv_ct FROM uv WHERE page_id = 'home' GROUP BY ch HAVING count(*) > 10")
def _(spark, folder):
    rows = dwd.unique_visitors(sample.page_log(spark, folder)).where(F.col("page.page_id") == "home")
    return rows.groupBy(F.col("common.ch").alias("ch")).agg(F.count(F.lit(1)).alias("uv_ct")).where(F.col("uv_ct") > 10)


# --- scalar functions --------------------------------------------------------------------------------


def function(name: str, sql: str, build, table: str = "events"):
    """One function over a whole table; ``build()`` gives the columns once a session exists."""

    @check(name, sql)
    def _(spark, folder):
        return sample.table(spark, folder, table).select(*build())


function("x1_day_of_text", f"SELECT o_orderkey, {day('o_orderdate')} AS v FROM orders",
         lambda: ["o_orderkey", times.day(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("v")], "orders")
function("x2_millis_to_text", f"SELECT event_id, {day('ts')} AS d, {stamp('ts')} AS s FROM events",
         lambda: ["event_id", times.day(times.from_millis(F.unix_millis("ts"))).alias("d"),
                  times.second(times.from_millis(F.unix_millis("ts"))).alias("s")])
function("x3_millis_to_second", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) * 1000000 AS v FROM events",
         lambda: ["event_id", F.unix_micros(times.from_millis_to_second(F.unix_millis("ts"))).alias("v")])
function("x4_seconds_to_millis", "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS v FROM orders",
         lambda: ["o_orderkey", F.unix_millis(times.from_seconds(F.unix_seconds("o_orderdate").cast("string"))).alias("v")], "orders")
function("x5_version_clock", f"SELECT event_id, {NOW_MS} AS v, 1 AS live FROM events",
         lambda: ["event_id", times.now_millis(now_ms()).alias("v"), F.when(times.now_millis() > now_ms(), 1).otherwise(0).alias("live")])
function("x6_row_time", "SELECT event_id, 1 AS live FROM events",
         lambda: ["event_id", F.when(times.now() > F.col("ts"), 1).otherwise(0).alias("live")])
function("x7_processing_time", "SELECT event_id, 1 AS v FROM events",
         # within ten minutes of the clock that the query was built by
         lambda: ["event_id", F.when(F.abs(F.unix_millis(times.now()) - int(time.time() * 1000)) < 600_000, 1).otherwise(0).alias("v")])
function("x8_day_before", f"SELECT event_id, {day('ts - INTERVAL 1 DAY')} AS v FROM events",
         lambda: ["event_id", times.day_before("ts").alias("v")])
function("x9_days_since", "SELECT event_id, CAST(date_diff('day', DATE '2023-12-25', CAST(ts AS DATE)) AS INT) AS v FROM events",
         lambda: ["event_id", times.days_since("ts", F.lit("2023-12-25")).alias("v")])
function("x10_conditionals", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 'back' ELSE 'kept' END AS a, coalesce(nullif(l_linestatus, 'O'), 'none') AS b FROM lineitem",
         lambda: ["l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_returnflag") == "R", "back").otherwise("kept").alias("a"),
                  F.coalesce(F.nullif("l_linestatus", F.lit("O")), F.lit("none")).alias("b")], "lineitem")
function("x11_casts", f"SELECT p_partkey, TRY_CAST(p_brand[7:] AS INT) AS i, TRY_CAST(p_name AS INT) AS bad, {text('CAST(p_retailprice AS DECIMAL(16,2))')} AS m FROM part",
         lambda: ["p_partkey", F.substring("p_brand", 7, 10).try_cast("int").alias("i"), F.col("p_name").try_cast("int").alias("bad"),
                  values.money(F.col("p_retailprice")).cast("string").alias("m")], "part")
function("x12_arithmetic", f"SELECT l_orderkey, l_partkey, l_linenumber, {text('CAST(l_quantity AS DECIMAL(16,2)) * CAST(l_extendedprice AS DECIMAL(16,2))')} AS m, CAST(l_quantity AS INT) - l_linenumber AS d FROM lineitem",
         lambda: ["l_orderkey", "l_partkey", "l_linenumber",
                  (F.col("l_quantity").cast("int").cast("string").cast(values.MONEY) * F.col("l_extendedprice").cast(values.MONEY)).cast("string").alias("m"),
                  (F.col("l_quantity").cast("int") - F.col("l_linenumber")).alias("d")], "lineitem")


@check("x13_blank_texts", "SELECT seq, CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS blank, CASE WHEN last_page_id IS NOT DISTINCT FROM 'login' THEN 1 ELSE 0 END AS same FROM pv")
def _(spark, folder):
    v = sample.page_views(spark, folder)
    one = lambda c: F.when(c, 1).otherwise(0)
    return v.select("seq", one(values.is_blank("last_page_id")).alias("blank"), one(F.col("last_page_id").eqNullSafe("login")).alias("same"))


@check("x14_listed_names", "SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'PROMO') THEN 1 ELSE 0 END AS v FROM part")
def _(spark, folder):
    part = sample.table(spark, folder, "part")
    return part.select("p_partkey", F.when(values.listed(F.lit("ECONOMY,SMALL,PROMO"), "p_type"), 1).otherwise(0).alias("v"))


@check("x15_version_time", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS newer FROM events")
def _(spark, folder):
    # .085 is later than .08, although it is smaller as text with its zone mark
    shown = F.concat(times.second("ts"), F.when(F.col("event_id") % 2 == 0, ".085Z").otherwise(".08Z"))
    limit = F.concat(times.second("ts"), F.lit(".08Z"))
    newer = times.version_time(shown) > times.version_time(limit)
    return sample.table(spark, folder, "events").select("event_id", F.when(newer, 1).otherwise(0).alias("newer"))


@check("x16_json_values", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, '{\"k\":' || CAST(json_extract_string(props, '$.k') AS INT) || '}' AS again FROM events")
def _(spark, folder):
    parsed = F.from_json("props", "k int")
    return sample.table(spark, folder, "events").select("event_id", parsed["k"].alias("k"), F.to_json(parsed).alias("again"))


@check("x17_map_null_check", "SELECT id, CASE WHEN old_status IS NOT NULL THEN 1 ELSE 0 END AS moved, order_status FROM oi")
def _(spark, folder):
    rows = sample.order_info(spark, folder)
    return rows.select(*cdc.fields("id"), F.when(cdc.before("order_status").isNotNull(), 1).otherwise(0).alias("moved"), *cdc.fields("order_status"))


@check("x18_case_of_names", "SELECT n_nationkey AS id, n_name AS name, upper(n_name) AS upper_name, lower(n_name) AS lower_name FROM nation")
def _(spark, folder):
    nation = sample.table(spark, folder, "nation")
    return nation.select(F.col("N_NATIONKEY").alias("id"), F.col("N_Name").alias("name"), F.upper("n_name").alias("upper_name"), F.lower("n_name").alias("lower_name"))


@check("x19_day_number", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS v FROM orders")
def _(spark, folder):
    return sample.table(spark, folder, "orders").select("o_orderkey", times.day_number("o_orderdate").alias("v"))


@check("x20_joined_key", "SELECT l_orderkey || '_' || l_partkey || '_' || l_linenumber AS v, count(*) AS n FROM lineitem GROUP BY v")
def _(spark, folder):
    line = sample.table(spark, folder, "lineitem")
    return line.groupBy(values.joined_key("l_orderkey", "l_partkey", "l_linenumber").alias("v")).agg(F.count(F.lit(1)).alias("n"))

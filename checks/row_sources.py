"""Sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.base import NOW_MS, check, now_ms, scratch
from checks.inputs import bounds, day, text
from checks.jobs import SKU_COLUMNS, facts, page_view_summary, province_summary, stored, written_dimensions
from millrace import schemas
from millrace.operators.unions import union_all
from millrace.plans import dim, dwd, dws
from millrace.sinks import external, tables
from millrace.sinks.dimensions import config_rows
from millrace.sources import lookups, sample, topics


@check("s1_raw_text", "SELECT seq, CASE WHEN seq % 50 = 7 THEN 'broken' ELSE mid END AS mid FROM lg WHERE seq % 50 <> 11")
def _(spark, folder):
    raw = sample.traffic_topic(spark, folder).withColumn("value", F.encode("value", "UTF-8"))
    text_rows = topics.raw_text(raw)
    mid = F.when(F.col("value").contains("broken"), "broken").otherwise(F.get_json_object("value", "$.common.mid"))
    return text_rows.select("seq", mid.alias("mid"))


@check("s2_json_table", "SELECT seq, ts_ms AS ts, mid, CASE WHEN NOT is_start THEN page_id END AS page_id, CASE WHEN NOT is_start THEN during_time END AS during_time FROM good_lg")
def _(spark, folder):
    rows = topics.json_table(sample.traffic_topic(spark, folder), schemas.TRAFFIC_LOG)
    return rows.select("seq", "ts", F.col("common.mid").alias("mid"), "page.page_id", "page.during_time")


@check("s3_change_envelope", f"SELECT id, kind AS type, {text('sec_at')} AS ts, order_status, old_status, user_id FROM oi")
def _(spark, folder):
    rows = topics.cdc_table(sample.change_topic(sample.order_info(spark, folder)))
    data, old = F.col("data"), F.col("old")
    return rows.select(data["id"].alias("id"), "type", "ts", data["order_status"].alias("order_status"),
                       old["order_status"].alias("old_status"), data["user_id"].alias("user_id"))


_CONFIG_SQL = """
SELECT source_table, sink_table, sink_columns, sink_pk, sink_extended FROM (VALUES
  ('sku_info', 'dim_sku_info', 'id,sku_name,tm_id,category3_id,spu_id', 'id', ''),
  ('base_province', 'dim_base_province', 'id,name,region_id,area_code', 'id', ''),
  ('base_trademark', 'dim_base_trademark', 'id,tm_name', 'id', 'SALT_BUCKETS = 3'))
  c(source_table, sink_table, sink_columns, sink_pk, sink_extended)"""


@check(
    "s4_config_snapshot",
    f"""SELECT c.*, n FROM ({_CONFIG_SQL}) c JOIN (
  SELECT 'sku_info' AS t, (SELECT count(*) FROM sku_writes) + (SELECT count(*) FROM part WHERE p_partkey % 11 = 0)
    + (SELECT count(*) FROM part WHERE p_partkey % 100 = 1) AS n
  UNION ALL SELECT 'base_province', count(*) FROM nation
  UNION ALL SELECT 'base_trademark', count(DISTINCT p_brand) FROM part) ON t = source_table""",
)
def _(spark, folder):
    config = lookups.latest_config(sample.config_changes(spark))
    counts = sample.dimension_log(spark, folder).groupBy("table").agg(F.count(F.lit(1)).alias("n"))
    return config.join(counts, F.col("table") == F.col("source_table")).drop("table")


@check("s5_dictionary_lookup", "SELECT dic_name AS payment_type_name, count(*) AS n FROM pay JOIN dic ON payment_type = dic_code GROUP BY dic_name")
def _(spark, folder):
    from millrace.operators.enrich import lookup

    rows = sample.payment_info(spark, folder).select(F.col("data")["payment_type"].alias("code"))
    return lookup(rows, lookups.dictionary(spark), "code", "payment_type_name").groupBy("payment_type_name").agg(F.count(F.lit(1)).alias("n"))


@check(
    "s6_composite_point_lookup",
    """SELECT k.l_orderkey, k.l_partkey, n_lines, quantity FROM (
  SELECT DISTINCT l_orderkey, l_partkey FROM refund_lines) k LEFT JOIN (
  SELECT l_orderkey, l_partkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem
  WHERE l_linestatus = 'O' GROUP BY ALL) d ON k.l_orderkey = d.l_orderkey AND k.l_partkey = d.l_partkey""",
)
def _(spark, folder):
    line = sample.table(spark, folder, "lineitem")
    keys = line.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_partkey").distinct()
    dim_rows = line.where(F.col("l_linestatus") == "O").groupBy("l_orderkey", "l_partkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )
    return lookups.point_lookup(dim_rows, keys)


@check("s7_summary_of_a_day", f"SELECT *, {NOW_MS} AS ts FROM province_window WHERE stt LIKE '1995-02-18%'")
def _(spark, folder):
    rows = province_summary(spark, folder, versions=True).where(F.col("dt") == 19950218)
    return tables.latest(rows, schemas.SUMMARY_KEYS["dws_trade_province_order_window"]).drop("dt")


@check("s8_upsert_topic", "SELECT id, count(*) AS versions FROM fact_versions WHERE l_partkey % 13 <> 0 GROUP BY id")
def _(spark, folder):
    rows = facts(spark, folder)
    tombstone = F.col("sku_id").cast("long") % 13 == 0
    columns = [F.col(c).cast("string").alias(c) for c in rows.columns if c in schemas.ORDER_DETAIL]
    topic = rows.select(F.when(~tombstone, F.to_json(F.struct(*columns))).alias("value"))
    return topics.upsert_table(topic, schemas.ORDER_DETAIL_FACT).groupBy("id").agg(F.count(F.lit(1)).alias("versions"))


@check(
    "s9_several_topics",
    """SELECT 'page' AS topic, ch, count(*) AS n FROM pv GROUP BY ch
UNION ALL SELECT 'visitor', ch, count(*) FROM uv GROUP BY ch UNION ALL SELECT 'jump', ch, count(*) FROM uj GROUP BY ch""",
)
def _(spark, folder):
    pages = sample.page_log(spark, folder)
    named = {"page": pages, "visitor": dwd.unique_visitors(pages), "jump": dwd.user_jumps(pages, 6 * 3600)}
    rows = union_all(*[df.select(F.lit(t).alias("topic"), F.col("common.ch").alias("ch")) for t, df in named.items()])
    return rows.groupBy("topic", "ch").agg(F.count(F.lit(1)).alias("n"))


# --- sinks -------------------------------------------------------------------------------------------


@check(
    "k1_topic_per_record",
    """SELECT topic, count(*) AS n FROM (
  SELECT 'dwd_traffic_err_log' AS topic FROM lg WHERE has_err UNION ALL SELECT 'dwd_traffic_start_log' FROM lg WHERE is_start
  UNION ALL SELECT 'dwd_traffic_page_log' FROM lg WHERE NOT is_start
  UNION ALL SELECT 'dwd_traffic_display_log' FROM (SELECT unnest(range(1, n_displays + 1)) FROM lg WHERE NOT is_start)
  UNION ALL SELECT 'dwd_traffic_action_log' FROM (SELECT unnest(range(1, n_actions + 1)) FROM lg WHERE NOT is_start))
GROUP BY topic""",
)
def _(spark, folder):
    from millrace.operators.routing import route_log

    return route_log(sample.traffic_log(spark, folder)).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@check(
    "k2_upsert_messages",
    """SELECT 'dwd_trade_cart_add' AS topic, '{"id":"' || id || '"}' AS key, to_json({'id': id, 'user_id': user_id, 'sku_id': sku_id,
  'sku_num': sku_num, 'source_type_code': source_type_code, 'source_type_name': source_type_name, 'ts': ts})::VARCHAR AS value
FROM cart_add""",
)
def _(spark, folder):
    rows = dwd.cart_adds(sample.cart_info(spark, folder), lookups.dictionary(spark))
    return external.upsert_messages(rows, ["id"], "dwd_trade_cart_add")


@check("k3_dimension_upsert", "SELECT id, sku_name, tm_id, category3_id, spu_id FROM dim_sku")
def _(spark, folder):
    # the second micro-batch meets a snapshot of the first
    return written_dimensions(spark, folder, snapshot=True).read(spark, "dim_sku_info", "id", SKU_COLUMNS)


@check(
    "k4_configured_columns",
    f"""SELECT sink_table, col AS "column", CASE WHEN col = sink_pk THEN 1 ELSE 0 END AS is_pk, coalesce(n, 0) AS n FROM (
  SELECT sink_table, sink_pk, unnest(string_split(sink_columns, ',')) AS col FROM ({_CONFIG_SQL})) c
LEFT JOIN (SELECT 'dim_sku_info' AS t, unnest(['id','sku_name','tm_id','category3_id','spu_id']) AS k, (SELECT count(*) FROM part) AS n
  UNION ALL SELECT 'dim_base_province', unnest(['id','name','region_id']), (SELECT count(*) FROM nation)
  UNION ALL SELECT 'dim_base_trademark', unnest(['id','tm_name']), (SELECT count(DISTINCT p_brand) FROM part)) w
ON t = sink_table AND k = col""",
)
def _(spark, folder):
    database = f"dims_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch(spark)}'")
    written_dimensions(spark, folder, database, ddl=True)
    parts = []
    for entry in config_rows(lookups.latest_config(sample.config_changes(spark))):
        table = spark.table(f"{database}.{entry['sink_table']}")
        for name in table.columns:
            is_pk = F.lit(int(name == entry["sink_pk"])).alias("is_pk")
            parts.append(table.agg(F.count(name).alias("n")).select(F.lit(entry["sink_table"]).alias("sink_table"), F.lit(name).alias("column"), is_pk, "n"))
    return union_all(*parts)


@check(
    "k5_declared_sink_columns",
    f"""SELECT {bounds('b', '10 SECOND')}, order_count, CAST(total AS DECIMAL(38,2)) AS order_amount FROM (
  SELECT time_bucket(INTERVAL '10 seconds', ts) AS b, count(DISTINCT order_id) AS order_count, sum(total) AS total
  FROM facts GROUP BY b)""",
)
def _(spark, folder):
    rows = dws.latest_amounts(facts(spark, folder), [], ["order_amount"])
    wide = dws.tumble_distinct(rows, [], "order_id", "order_count", ["order_amount"], now=now_ms())
    wide = wide.withColumn("order_amount", F.col("order_amount").cast("decimal(38,2)"))
    return tables.sink_columns(wide, ["stt", "edt", "order_count", "order_amount"])


@check(
    "k6_replacing_read",
    f"""SELECT day, province_id, status, ver FROM (
  SELECT {day('o_orderdate')} AS day, {text('o_custkey % 25')} AS province_id, o_orderstatus AS status, o_orderkey AS ver,
    row_number() OVER (PARTITION BY o_orderdate, o_custkey % 25 ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def _(spark, folder):
    o = sample.table(spark, folder, "orders")
    rows = o.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), (F.col("o_custkey") % 25).cast("string").alias("province_id"),
                    F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("ver"))
    return tables.latest(rows, ["day", "province_id"], "ver")


@check(
    "k7_day_partition",
    """SELECT CAST(strftime(ts, '%Y%m%d') AS INT) AS dt, count(*) AS n
FROM (SELECT DISTINCT date_trunc('hour', ts) AS ts, vc, ch, ar, is_new FROM pv) WHERE ts >= '2024-01-05' GROUP BY dt""",
)
def _(spark, folder):
    # written twice: the second micro-batch replaces the first row by row
    rows = page_view_summary(spark, folder)
    table = stored(spark, "dws_traffic_vc_ch_ar_is_new_page_view_window", rows.withColumn("ts", F.col("ts") - 1), rows)
    current = tables.latest(table.versions(spark).where(F.col("dt") >= 20240105), table.keys)
    return current.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@check("k8_by_position", "SELECT id AS a, user_id AS b, sku_id AS c, sku_num AS d, source_type_code AS e, source_type_name AS f, ts AS g FROM cart_add")
def _(spark, folder):
    rows = dwd.cart_adds(sample.cart_info(spark, folder), lookups.dictionary(spark))
    return tables.by_position(rows, list("abcdefg"))


@check(
    "k9_append_only_rows",
    """SELECT keyword, count(*) AS windows, CAST(sum(n) AS BIGINT) AS keyword_count FROM (
  SELECT h, keyword, count(*) AS n FROM (
    SELECT date_trunc('hour', ts) AS h, unnest(string_split(item, ' ')) AS keyword FROM pv
    WHERE last_page_id = 'search' AND item IS NOT NULL) GROUP BY h, keyword) GROUP BY keyword""",
)
def _(spark, folder):
    rows = dws.keyword_views(sample.page_log(spark, folder, items=True), "1 hour", now_ms())
    typed = rows.selectExpr("CAST(stt AS TIMESTAMP) stt", "CAST(edt AS TIMESTAMP) edt", "source", "keyword", "keyword_count", "ts")
    return typed.groupBy("keyword").agg(F.count(F.lit(1)).alias("windows"), F.sum("keyword_count").alias("keyword_count"))


@check(
    "k10_refreshed_dimension",
    f"""SELECT sku_id, sku_name, tm_id, orders FROM (
  SELECT {text('l_partkey')} AS sku_id, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY l_partkey) o
LEFT JOIN dim_sku ON sku_id = id""",
)
def _(spark, folder):
    from millrace.operators.enrich import enrich

    # read again after the second micro-batch
    snapshot = written_dimensions(spark, folder, snapshot=True).read(spark, "dim_sku_info", "id", SKU_COLUMNS)
    line = sample.table(spark, folder, "lineitem")
    orders = line.select(F.col("l_partkey").cast("string").alias("sku_id"), "l_orderkey").distinct()
    orders = orders.groupBy("sku_id").agg(F.count(F.lit(1)).alias("orders"))
    return enrich(orders, snapshot, "sku_id", {"sku_name": "sku_name", "tm_id": "tm_id"})


@check("k11_json_value", "SELECT '{\"seq\":' || seq || ',\"mid\":\"' || mid || '\",\"page\":{\"page_id\":\"' || page_id || '\",\"during_time\":' || during_time || '},\"ts\":' || ts_ms || '}' AS value FROM pv")
def _(spark, folder):
    v = sample.page_views(spark, folder)
    rows = v.select("seq", "mid", F.struct("page_id", "during_time").alias("page"), F.col("ts_ms").alias("ts"))
    return external.json_value(rows)

"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import check
from checks.inputs import text
from checks.jobs import facts, pre_processed
from millrace.functions import cdc, text as text_functions
from millrace.operators.enrich import enrich, flatten_sku, lookup
from millrace.operators.joins import ORDER_WAIT, bounded_join
from millrace.operators.routing import route_changes
from millrace.operators.changes import clean_changes
from millrace.sources import lookups, sample


def lines(spark, folder):
    rows = sample.change_log(spark, folder).where(cdc.routed("order_detail", "insert"))
    return rows.select(*cdc.fields("id", "order_id", "sku_id", "split_total_amount"), F.col("ts").alias("od_ts"), "event_time")


def orders(spark, folder):
    rows = sample.change_log(spark, folder).where(cdc.routed("order_info", "insert", "update"))
    return rows.select(cdc.field("id").alias("_order"), *cdc.fields("user_id", "order_status"), F.col("ts").alias("oi_ts"), "event_time")


def optional(spark, folder, table, *names):
    rows = sample.change_log(spark, folder).where(cdc.routed(table, "insert"))
    return rows.select(*cdc.fields("order_detail_id", *names), "event_time")


@check(
    "j1_bounded_inner_join",
    f"""SELECT od.id, od.order_id, od.sku_id, od.split_total_amount, {text('od.sec_at')} AS od_ts, oi.user_id, oi.order_status,
  {text('oi.sec_at')} AS oi_ts FROM od JOIN oi ON od.order_id = oi.id AND abs(od.sec_at - oi.sec_at) <= 905""",
)
def _(spark, folder):
    joined = bounded_join(lines(spark, folder), orders(spark, folder), {"order_id": "_order"}, ORDER_WAIT)
    return joined.drop("event_time")


@check(
    "j2_bounded_left_join",
    """SELECT od.id, od.sku_id, od.split_total_amount, activity_id, activity_rule_id FROM od
LEFT JOIN act ON od.id = order_detail_id AND abs(od.sec_at - act.sec_at) <= 905""",
)
def _(spark, folder):
    activity = optional(spark, folder, "order_detail_activity", "activity_id", "activity_rule_id")
    joined = bounded_join(lines(spark, folder), activity, {"id": "order_detail_id"}, ORDER_WAIT, "left_outer")
    return joined.drop("event_time", "order_id", "od_ts")


@check("j3_five_way_join", "SELECT order_status, type, activity_id, coupon_id, source_type_name, count(*) AS n FROM pre GROUP BY ALL")
def _(spark, folder):
    keys = ["order_status", "type", "activity_id", "coupon_id", "source_type_name"]
    return pre_processed(spark, folder).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@check("j4_dictionary_join", "SELECT id, source_type, dic_name AS source_type_name FROM od JOIN dic ON source_type = dic_code")
def _(spark, folder):
    rows = sample.change_log(spark, folder).where(cdc.routed("order_detail", "insert")).select(*cdc.fields("id", "source_type"))
    return lookup(rows, lookups.dictionary(spark), "source_type", "source_type_name")


@check(
    "j5_one_dictionary_two_roles",
    """SELECT t.dic_name AS type_name, r.dic_name AS reason_name, count(*) AS n FROM ri JOIN dic t ON refund_type = t.dic_code
JOIN dic r ON refund_reason_type = r.dic_code GROUP BY ALL""",
)
def _(spark, folder):
    dic = lookups.dictionary(spark)
    rows = sample.change_log(spark, folder).where(cdc.routed("order_refund_info", "insert"))
    rows = rows.select(*cdc.fields("refund_type", "refund_reason_type"))
    rows = lookup(lookup(rows, dic, "refund_type", "type_name"), dic, "refund_reason_type", "reason_name")
    return rows.groupBy("type_name", "reason_name").agg(F.count(F.lit(1)).alias("n"))


@check(
    "j6_composite_key_join",
    """SELECT rp.id, rp.order_id, rp.sku_id, ri.refund_num FROM rp JOIN ri ON rp.order_id = ri.order_id AND rp.sku_id = ri.sku_id
  AND ri.was_moved WHERE rp.refund_status = '0701'""",
)
def _(spark, folder):
    rows = sample.change_log(spark, folder)
    paid = rows.where(cdc.routed("refund_payment") & cdc.transitioned("refund_status", "0701"))
    paid = paid.select(*cdc.fields("id", "order_id", "sku_id"), "event_time")
    moved = rows.where(cdc.routed("order_refund_info") & cdc.transitioned("refund_status", "0705"))
    moved = moved.select(cdc.field("order_id").alias("_o"), cdc.field("sku_id").alias("_s"), *cdc.fields("refund_num"), "event_time")
    return bounded_join(paid, moved, {"order_id": "_o", "sku_id": "_s"}, 3600).drop("event_time")


@check(
    "j7_dimension_after_aggregation",
    """SELECT province_id, coalesce(name, '') AS province_name, n FROM (
  SELECT province_id, count(DISTINCT order_id) AS n FROM facts GROUP BY province_id) LEFT JOIN province ON province_id = id""",
)
def _(spark, folder):
    n = facts(spark, folder).groupBy("province_id").agg(F.countDistinct("order_id").alias("n"))
    rows = enrich(n, sample.provinces(spark, folder), "province_id", {"name": "province_name"})
    return rows.withColumn("province_name", F.coalesce("province_name", F.lit("")))


@check("j8_flattened_products", "SELECT * FROM flat_sku")
def _(spark, folder):
    return flatten_sku(sample.sku_dims(spark, folder))


@check(
    "j9_configured_tables",
    """SELECT 'dim_sku_info' AS sink_table, count(*) AS n FROM sku_writes UNION ALL SELECT 'dim_base_province', count(*) FROM nation
UNION ALL SELECT 'dim_base_trademark', count(DISTINCT p_brand) FROM part""",
)
def _(spark, folder):
    config = lookups.latest_config(sample.config_changes(spark))
    rows = route_changes(clean_changes(sample.dimension_log(spark, folder)), config)
    return rows.groupBy("sink_table").agg(F.count(F.lit(1)).alias("n"))


@check("j10_lateral_words", "SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS word FROM part")
def _(spark, folder):
    text_functions.register(spark)
    sample.table(spark, folder, "part").select("p_partkey", "p_name").createOrReplaceTempView("millrace_part")
    return spark.sql("SELECT p_partkey, word FROM millrace_part, LATERAL tokenize(p_name)")


@check(
    "j11_payment_to_lines",
    """SELECT pay.order_id, count(*) AS lines FROM pay JOIN od ON pay.order_id = od.order_id
WHERE pay.kind = 'update' AND payment_status = '1602' GROUP BY pay.order_id""",
)
def _(spark, folder):
    paid = sample.change_log(spark, folder).where(cdc.routed("payment_info", "update") & (cdc.field("payment_status") == "1602"))
    paid = paid.select(cdc.field("order_id").alias("_o"), "event_time")
    joined = bounded_join(lines(spark, folder), paid, {"order_id": "_o"}, 7200)
    return joined.groupBy("order_id").agg(F.count(F.lit(1)).alias("lines"))

"""Keyed state, patterns, routing and user functions, in their table form."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from checks.base import check
from checks.inputs import day
from checks.jobs import SIX_HOURS, facts
from millrace.functions import text, times
from millrace.operators.accumulators import accumulate
from millrace.operators.bounce import timeouts
from millrace.operators.changes import entry_page, is_login
from millrace.operators.enrich import enrich
from millrace.operators.joins import ORDER_WAIT, bounded_join
from millrace.operators.routing import action_rows, display_rows, split_log
from millrace.operators.windows import behind_watermark
from millrace.operators.visitors import first_per_day, login_days, repair_new_visitor
from millrace.operators.dedup import latest_version
from millrace.plans import dwd
from millrace.sources import lookups, sample, topics


@check("e1_event_time", "SELECT seq, CAST(epoch_us(ts) AS BIGINT) // 1000 * 1000 AS rowtime_us FROM pv")
def _(spark, folder):
    rows = topics.page_time(sample.page_log(spark, folder).drop("rowtime"))
    return rows.select("seq", F.unix_micros("rowtime").alias("rowtime_us"))


@check(
    "e2_late_rows",
    """SELECT late, count(*) AS n FROM (
  SELECT ts < max(ts) OVER (ORDER BY arrival, seq ROWS UNBOUNDED PRECEDING) - INTERVAL 60 SECOND AS late
  FROM (SELECT *, seq + CASE WHEN seq % 10 = 3 THEN 40 ELSE 0 END AS arrival FROM pv)) GROUP BY late""",
)
def _(spark, folder):
    # events are numbered in the order of their time; every tenth arrives 40 events later
    v = sample.page_views(spark, folder).withColumn("arrival", F.expr("seq + CASE WHEN seq % 10 = 3 THEN 40 ELSE 0 END"))
    return behind_watermark(v, "ts", ["arrival", "seq"], 60, "arrival").groupBy("late").agg(F.count(F.lit(1)).alias("n"))


@check("e3_join_wait", "SELECT kind, count(*) AS n FROM od JOIN oi ON od.order_id = oi.id WHERE abs(od.sec_at - oi.sec_at) <= 905 GROUP BY kind")
def _(spark, folder):
    left = sample.order_detail(spark, folder).select(F.col("data")["order_id"].alias("order_id"), "event_time")
    right = sample.order_info(spark, folder).select(F.col("data")["id"].alias("_o"), F.col("type").alias("kind"), "event_time")
    joined = bounded_join(left, right, {"order_id": "_o"}, ORDER_WAIT)
    return joined.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@check("e4_state_of_a_day", f"SELECT {day('ts')} AS day, count(DISTINCT mid) AS n FROM pv WHERE coalesce(last_page_id, '') = '' GROUP BY 1")
def _(spark, folder):
    rows = dwd.unique_visitors(sample.page_log(spark, folder))
    return rows.groupBy(times.day("rowtime").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@check("e5_grouping_by_four_keys", "SELECT vc, ch, ar, is_new, count(*) AS n FROM pv GROUP BY vc, ch, ar, is_new")
def _(spark, folder):
    return sample.page_views(spark, folder).groupBy("vc", "ch", "ar", "is_new").agg(F.count(F.lit(1)).alias("n"))


@check("d1_first_per_key_and_day", "SELECT mid, page_id, seq FROM (SELECT *, row_number() OVER (PARTITION BY mid, page_id, CAST(ts AS DATE) ORDER BY ts, seq) AS rn FROM pv) WHERE rn = 1")
def _(spark, folder):
    rows = sample.page_views(spark, folder).withColumnRenamed("ts", "rowtime")
    return first_per_day(rows, "mid", also=["page_id"]).select("mid", "page_id", "seq")


@check("d2_latest_version", "SELECT id, user_id, CAST(total AS DECIMAL(16,2)) AS split_total_amount FROM facts")
def _(spark, folder):
    return latest_version(facts(spark, folder), ["id"], "row_op_ts", "seq").select("id", "user_id", "split_total_amount")


@check(
    "d3_new_visitor_repair",
    """SELECT seq, mid, CASE WHEN is_new = '1' AND CAST(ts AS DATE) <> origin THEN '0' ELSE is_new END AS is_new FROM (
  SELECT *, first_value(CASE WHEN is_new = '1' THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END)
    OVER (PARTITION BY mid ORDER BY ts, seq) AS origin FROM pv)""",
)
def _(spark, folder):
    rows = sample.page_views(spark, folder).withColumnRenamed("ts", "rowtime").select("seq", "mid", "is_new", "rowtime")
    return repair_new_visitor(rows, "mid", "is_new").drop("rowtime")


@check("d3_new_visitor_repair_salted", """SELECT seq, CASE WHEN is_new = '1' AND CAST(ts AS DATE) <> origin THEN '0' ELSE is_new END AS is_new FROM (
  SELECT *, first_value(CASE WHEN is_new = '1' THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END)
    OVER (PARTITION BY vc ORDER BY ts, seq) AS origin FROM pv)""")
def _(spark, folder):
    # four keys hold all rows
    rows = sample.page_views(spark, folder).withColumnRenamed("ts", "rowtime").select("seq", "vc", "is_new", "rowtime")
    return repair_new_visitor(rows, "vc", "is_new").select("seq", "is_new")


@check("d4_login_and_return", f"SELECT uid, {day('ts')} AS day, CAST(1 AS BIGINT) AS uu_ct, CAST(CASE WHEN d - last_d >= 3 THEN 1 ELSE 0 END AS BIGINT) AS back_ct FROM login_day")
def _(spark, folder):
    logins = sample.page_log(spark, folder).where(is_login()).select(F.col("common.uid").alias("uid"), "rowtime")
    days = login_days(logins, "uid", min_days=3)
    return days.select("uid", times.day("rowtime").alias("day"), "uu_ct", "back_ct")


@check("c1_bounce_pattern", "SELECT seq, mid FROM uj")
def _(spark, folder):
    return dwd.user_jumps(sample.page_log(spark, folder), SIX_HOURS).select("seq", F.col("common.mid").alias("mid"))


@check("c1_bounce_pattern_ten_seconds", "SELECT seq, mid FROM nx WHERE entry AND (next_ts IS NULL OR next_ts - ts >= INTERVAL 10 SECOND OR next_entry)")
def _(spark, folder):
    return dwd.user_jumps(sample.page_log(spark, folder)).select("seq", F.col("common.mid").alias("mid"))


@check("c2_timed_out_pattern", "SELECT seq, mid FROM nx WHERE entry AND (next_ts IS NULL OR next_ts - ts >= INTERVAL 6 HOUR)")
def _(spark, folder):
    rows = sample.page_log(spark, folder).withColumn("mid", F.col("common.mid"))
    return timeouts(rows, "mid", entry_page(), within_seconds=SIX_HOURS).select("seq", "mid")


@check(
    "r1_typed_log_outputs",
    """SELECT 'dwd_traffic_err_log' AS topic, seq, 'actions,common,displays,err,page,rowtime,seq,start,ts' AS fields FROM lg WHERE has_err
UNION ALL SELECT 'dwd_traffic_start_log', seq, 'actions,common,displays,page,rowtime,seq,start,ts' FROM lg WHERE is_start
UNION ALL SELECT 'dwd_traffic_page_log', seq, 'common,page,rowtime,seq,ts' FROM lg WHERE NOT is_start""",
)
def _(spark, folder):
    outputs = split_log(sample.traffic_log(spark, folder))
    kept = ["dwd_traffic_err_log", "dwd_traffic_start_log", "dwd_traffic_page_log"]
    parts = [outputs[t].select(F.lit(t).alias("topic"), "seq", F.lit(",".join(sorted(outputs[t].columns))).alias("fields")) for t in kept]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check(
    "r2_exploded_records",
    """SELECT 'display' AS kind, seq, mid, 'd' || i AS item FROM lg, range(1, 4) r(i) WHERE NOT is_start AND i <= n_displays
UNION ALL SELECT 'action', seq, mid, 'a' || i FROM lg, range(1, 3) r(i) WHERE NOT is_start AND i <= n_actions""",
)
def _(spark, folder):
    log = sample.traffic_log(spark, folder)
    columns = lambda kind: [F.lit(kind).alias("kind"), "seq", F.col("common.mid").alias("mid"), F.col(kind)["item"].alias("item")]
    return display_rows(log).select(*columns("display")).unionByName(action_rows(log).select(*columns("action")))


@check(
    "b1_config_state",
    """SELECT state, c_mktsegment, count(*) AS customers, CASE WHEN state = 'put' THEN count(*) ELSE 0 END AS configured
FROM customer, (VALUES ('put'), ('removed')) s(state) GROUP BY state, c_mktsegment""",
)
def _(spark, folder):
    # the user table is configured by the fifth change and its configuration deleted by the sixth
    changes = sample.config_changes(spark)
    customer = sample.table(spark, folder, "customer").withColumn("t", F.lit("user_info"))

    def hits(state: str, until: int):
        config = lookups.latest_config(changes.where(F.col("seq") <= until)).where(F.col("source_table") == "user_info")
        hit = customer.join(config, F.col("t") == F.col("source_table"), "left").withColumn("state", F.lit(state))
        return hit.groupBy("state", "c_mktsegment").agg(F.count(F.lit(1)).alias("customers"), F.count("source_table").alias("configured"))

    return hits("put", 5).unionByName(hits("removed", 6))


@check("b2_settled_versions", "SELECT versions, count(*) AS ids FROM (SELECT id, count(*) AS versions FROM fact_versions GROUP BY id) GROUP BY versions")
def _(spark, folder):
    rows = facts(spark, folder)
    settled = latest_version(rows, ["id"], "row_op_ts", "seq").select("id")
    counts = rows.groupBy("id").agg(F.count(F.lit(1)).alias("versions"))
    return counts.join(settled, "id").groupBy("versions").agg(F.count(F.lit(1)).alias("ids"))


@check("g1_keywords", "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS word FROM part) GROUP BY word")
def _(spark, folder):
    words = sample.table(spark, folder, "part").select(F.explode(text.words("p_name")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@check("g1_dictionary_keywords", "SELECT p_partkey, lower(p_name) AS joined FROM part")
def _(spark, folder):
    # names without blanks are cut back into the words of the dictionary
    part = sample.table(spark, folder, "part")
    dictionary = part.select(F.explode(text.words("p_name")).alias("word"))
    cut = text.segmented(part, F.replace("p_name", F.lit(" "), F.lit("")), dictionary)
    return cut.select("p_partkey", F.concat_ws(" ", "words").alias("joined"))


@check("g2_scalar_map_and_filter", "SELECT seq, upper(page_id) AS page FROM pv WHERE page_id <> 'error'")
def _(spark, folder):
    return sample.page_views(spark, folder).where(F.col("page_id") != "error").select("seq", F.upper("page_id").alias("page"))


@check(
    "g3_custom_aggregate",
    "SELECT page_id, count(*) AS n, CAST(max(during_time) - min(during_time) AS BIGINT) AS span, CAST(bit_xor(seq) AS BIGINT) AS mark FROM pv GROUP BY page_id",
)
def _(spark, folder):
    rows = sample.page_views(spark, folder).select("page_id", F.col("during_time").cast("long").alias("t"), F.col("seq").cast("long").alias("seq"))
    return accumulate(
        rows,
        ["page_id"],
        create=lambda: (0, 2**62, -(2**62), 0),
        add=lambda s, r: (s[0] + len(r), min(s[1], int(r["t"].min())), max(s[2], int(r["t"].max())), s[3] ^ int(np.bitwise_xor.reduce(r["seq"].to_numpy()))),
        merge=lambda a, b: (a[0] + b[0], min(a[1], b[1]), max(a[2], b[2]), a[3] ^ b[3]),
        result=lambda s: {"n": s[0], "span": s[2] - s[1], "mark": s[3]},
        state="n long, low long, high long, mark long",
        returns="n long, span long, mark long",
    )


@check("g4_keyed_function", "SELECT mid, count(*) AS days FROM (SELECT DISTINCT mid, CAST(ts AS DATE) FROM uv) GROUP BY mid")
def _(spark, folder):
    rows = dwd.unique_visitors(sample.page_log(spark, folder))
    return rows.groupBy(F.col("common.mid").alias("mid")).agg(F.count(F.lit(1)).alias("days"))


@check("g5_enrich_template", "SELECT sku_id, trademark_name FROM flat_sku")
def _(spark, folder):
    dims = sample.sku_dims(spark, folder)
    rows = dims["dim_sku_info"].select(F.col("id").alias("sku_id"), "tm_id")
    return enrich(rows, dims["dim_base_trademark"], "tm_id", {"tm_name": "trademark_name"}).drop("tm_id")

"""Aggregates, windows, sorting, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import NOW_MS, check, now_ms
from checks.inputs import bounds
from checks.jobs import HOUR, SIX_HOURS, carts, facts, page_view_summary, province_summary
from millrace import schemas
from millrace.functions.values import flag, is_blank
from millrace.operators.bounce import next_row
from millrace.operators.dedup import latest_row
from millrace.operators.unions import union_all
from millrace.operators.windows import buffered, sums, tumble, tumble_distinct
from millrace.plans import ads, dwd, dws
from millrace.sources import sample

TEN = "time_bucket(INTERVAL '10 seconds', ts)"


def views(spark, folder):
    return sample.page_views(spark, folder).withColumnRenamed("ts", "rowtime")


@check(
    "a1_keyed_window_sums",
    f"""SELECT {bounds('b', '1 HOUR')}, ch, CAST(sum(during_time) AS BIGINT) AS dur_sum, count(*) AS pv_ct FROM (
  SELECT date_trunc('hour', ts) AS b, ch, during_time FROM pv) GROUP BY b, ch""",
)
def _(spark, folder):
    aggs = [F.sum("during_time").alias("dur_sum"), F.count(F.lit(1)).alias("pv_ct")]
    return tumble(views(spark, folder), aggs, ["ch"], HOUR).drop("ts")


@check("a2_global_window_sums", f"SELECT {bounds('b', '1 HOUR')}, CAST(sum(during_time) AS BIGINT) AS dur_sum FROM (SELECT date_trunc('hour', ts) AS b, during_time FROM pv) GROUP BY b")
def _(spark, folder):
    return tumble(views(spark, folder), sums("during_time"), None, HOUR).withColumnRenamed("during_time", "dur_sum").drop("ts")


@check("a3_window_counter", f"SELECT {bounds('b', '1 HOUR')}, count(*) AS cart_add_uu_ct FROM (SELECT date_trunc('hour', sec_at) AS b FROM cart_add) GROUP BY b")
def _(spark, folder):
    return tumble(carts(spark, folder), [F.count(F.lit(1)).alias("cart_add_uu_ct")], None, HOUR).drop("ts")


@check(
    "a4_count_per_keyword",
    f"""SELECT {bounds('b', '1 HOUR')}, keyword, count(*) AS keyword_count FROM (
  SELECT date_trunc('hour', ts) AS b, unnest(string_split(item, ' ')) AS keyword FROM pv
  WHERE last_page_id = 'search' AND item IS NOT NULL) GROUP BY b, keyword""",
)
def _(spark, folder):
    return dws.keyword_views(sample.page_log(spark, folder, items=True), HOUR).drop("ts", "source")


@check(
    "a5_exact_distinct_orders",
    f"""SELECT {bounds('b', '10 SECOND')}, sku_id, count(DISTINCT order_id) AS order_count, CAST(sum(total) AS DECIMAL(38,2)) AS order_amount
FROM (SELECT {TEN} AS b, * FROM facts) GROUP BY b, sku_id""",
)
def _(spark, folder):
    rows = dws.latest_amounts(facts(spark, folder), ["sku_id"], ["order_amount"])
    out = tumble_distinct(rows, ["sku_id"], "order_id", "order_count", ["order_amount"]).drop("ts")
    return out.withColumn("order_amount", F.col("order_amount").cast("decimal(38,2)"))


@check(
    "a6_sum_of_a_day",
    """SELECT d AS dt, CAST(sum(order_amount) AS DECIMAL(38,2)) AS order_amount FROM (SELECT unnest([19950218, 19960301, 21990101]) AS d)
LEFT JOIN province_window ON left(stt, 10) = strftime(strptime(CAST(d AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') GROUP BY d""",
)
def _(spark, folder):
    # two days with rows and one without: each is one row
    days = [19950218, 19960301, 21990101]
    return union_all(*[ads.gmv(province_summary(spark, folder, date=d), d).select(F.lit(d).alias("dt"), "order_amount") for d in days])


@check("a7_sum_per_key", "SELECT province_name, CAST(sum(order_amount) AS DECIMAL(38,2)) AS order_amount, CAST(sum(order_count) AS BIGINT) AS order_count FROM province_window GROUP BY province_name")
def _(spark, folder):
    rows = province_summary(spark, folder).groupBy("province_name")
    return rows.agg(F.sum("order_amount").cast("decimal(38,2)").alias("order_amount"), F.sum("order_count").alias("order_count"))


@check("a8_window_decoration", f"SELECT {bounds('b', '10 SECOND')}, count(*) AS n, {NOW_MS} AS ts FROM (SELECT {TEN} AS b FROM pv) GROUP BY b")
def _(spark, folder):
    return tumble(views(spark, folder), [F.count(F.lit(1)).alias("n")], now=now_ms())


@check(
    "a9_conditional_counts",
    """SELECT ch, CAST(sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS BIGINT) AS home_ct,
  CAST(sum(CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END) AS BIGINT) AS detail_ct,
  CAST(sum(CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END) AS BIGINT) AS sv_ct FROM pv GROUP BY ch""",
)
def _(spark, folder):
    home, detail = flag(F.col("page_id") == "home"), flag(F.col("page_id") == "good_detail")
    return sample.page_views(spark, folder).groupBy("ch").agg(
        F.sum(home).alias("home_ct"), F.sum(detail).alias("detail_ct"), F.sum(flag(is_blank("last_page_id"))).alias("sv_ct")
    )


@check("w1_keyed_ten_seconds", f"SELECT {bounds('b', '10 SECOND')}, mid, count(*) AS n FROM (SELECT {TEN} AS b, mid FROM pv) GROUP BY b, mid")
def _(spark, folder):
    return tumble(views(spark, folder), [F.count(F.lit(1)).alias("n")], ["mid"]).drop("ts")


@check("w2_global_ten_seconds", f"SELECT {bounds('b', '10 SECOND')}, CAST(sum(during_time) AS BIGINT) AS during_time FROM (SELECT {TEN} AS b, during_time FROM pv) GROUP BY b")
def _(spark, folder):
    return tumble(views(spark, folder), sums("during_time")).drop("ts")


@check("w3_sql_group_window", f"SELECT {bounds('b', '10 SECOND')}, vc, count(*) AS n FROM (SELECT {TEN} AS b, vc FROM pv) GROUP BY b, vc")
def _(spark, folder):
    views(spark, folder).createOrReplaceTempView("millrace_views")
    return spark.sql(
        """SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt, date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
           vc, count(*) AS n FROM millrace_views GROUP BY window(rowtime, '10 seconds'), vc"""
    )


@check(
    "w4_buffered_window",
    f"""SELECT {bounds('b', '1 HOUR')}, mid, string_agg(page_id, '>' ORDER BY ts, seq) AS path, count(*) AS n FROM (
  SELECT date_trunc('hour', ts) AS b, * FROM pv) GROUP BY b, mid""",
)
def _(spark, folder):
    rows = buffered(views(spark, folder), ["page_id"], ["rowtime", "seq"], ["mid"], HOUR)
    path = F.array_join(F.transform("rows", lambda r: r["page_id"]), ">").alias("path")
    return rows.select("stt", "edt", "mid", path, F.size("rows").cast("long").alias("n"))


@check("w5_next_event_of_key", "SELECT seq, lead(page_id) OVER (PARTITION BY mid, CAST(ts AS DATE) ORDER BY ts, seq) AS next_page_id FROM pv")
def _(spark, folder):
    rows = sample.page_views(spark, folder).withColumn("mid_day", F.concat("mid", F.lit("/"), F.to_date("ts")))
    return next_row(rows, "mid_day", "ts", "seq", "page_id").select("seq", "next_page_id")


@check("w6_latest_per_key", "SELECT id, order_id, sku_id, original AS split_original_amount FROM facts")
def _(spark, folder):
    rows = latest_row(facts(spark, folder), ["id"], ["row_op_ts", "seq"])
    return rows.select("id", "order_id", "sku_id", "split_original_amount")


@check("t1_top_channels", "SELECT ch, CAST(sum(uv_ct) AS BIGINT) AS uv_ct FROM view_window WHERE stt LIKE '2024-01-06%' GROUP BY ch HAVING sum(uv_ct) > 0 ORDER BY uv_ct DESC, ch LIMIT 20")
def _(spark, folder):
    return ads.top_channels(page_view_summary(spark, folder), 20240106)


@check("t2_clustered_summary", "SELECT left(stt, 10) AS day, count(*) AS n, min(vc || ch || ar || is_new) AS first_key FROM view_window GROUP BY 1")
def _(spark, folder):
    rows = page_view_summary(spark, folder)
    keys = schemas.SUMMARY_KEYS["dws_traffic_vc_ch_ar_is_new_page_view_window"]
    clustered = rows.sortWithinPartitions(*keys)
    first = F.min(F.concat("vc", "ch", "ar", "is_new")).alias("first_key")
    return clustered.groupBy(F.left("stt", F.lit(10)).alias("day")).agg(F.count(F.lit(1)).alias("n"), first)


@check(
    "u1_three_inputs_one_schema",
    """SELECT vc, CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
  CAST(sum(dur_sum) AS BIGINT) AS dur_sum, CAST(sum(uj_ct) AS BIGINT) AS uj_ct FROM view_window GROUP BY vc""",
)
def _(spark, folder):
    pages = sample.page_log(spark, folder)
    rows = dws.page_view_measures(pages, dwd.unique_visitors(pages), dwd.user_jumps(pages, SIX_HOURS))
    return rows.groupBy("vc").agg(*sums("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct"))


@check(
    "u2_matched_and_timed_out",
    """SELECT CASE WHEN next_ts IS NULL OR next_ts - ts >= INTERVAL 6 HOUR THEN 'timeout' ELSE 'match' END AS kind, count(*) AS n
FROM uj GROUP BY 1""",
)
def _(spark, folder):
    both = dwd.judged_entries(sample.page_log(spark, folder), SIX_HOURS)
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))

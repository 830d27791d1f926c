"""Streaming forms of jobs and operators: the test tables are read as streams, the results from the sink.

Rows that only a later event would release are left to the tests; the queries here emit all their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import check, scratch
from checks.inputs import bounds, day, text
from checks.jobs import DIMENSION_CELLS, HOUR, SIX_HOURS, SKU_COLUMNS
from millrace.functions import cdc, times
from millrace.operators.bounce import timeouts
from millrace.operators.changes import entry_page, is_login
from millrace.operators.joins import ORDER_WAIT, bounded_join
from millrace.operators.unions import union_all
from millrace.operators.visitors import login_days
from millrace.operators.windows import sums, tumble
from millrace.plans import dim, dwd
from millrace.sinks.dimensions import DimensionStore
from millrace.sinks.tables import FactTable, VersionedTable
from millrace.sources import lookups, sample
from millrace.streaming.runner import run_once
from millrace.streaming.stateful import hold_delay


def through(spark, df: DataFrame) -> DataFrame:
    """Run a stream to the end of its input and read what it wrote."""
    folder = scratch(spark)
    sink = FactTable(f"{folder}/rows")
    run_once(df, sink.append, f"{folder}/checkpoint")
    return sink.read(spark)


#: Rows of a file of a micro-batch, so that it is written and read by several tasks.
FILE_ROWS = 250_000


def in_files(spark, df: DataFrame, by: str, n: int = 4, turned: bool = False) -> DataFrame:
    """A table as a stream of ``n`` micro-batches in the order of ``by``; ``turned``: the last one first.

    Each has the same number of files: one, or more where there are many rows. Files that are missing to that are empty ones.
    """
    path = f"{scratch(spark)}/in"
    cuts = df.approxQuantile("_at", [k / n for k in range(1, n)], 0.01) if "_at" in df.columns else []
    part = sum((F.when(F.col(by) > c, 1).otherwise(0) for c in cuts), F.lit(0))
    files = -(-df.count() // (n * FILE_ROWS)) or 1
    written = 0
    for k in range(n)[:: -1 if turned else 1]:
        rows = df.where(part == k).drop("_at")
        (rows.repartition(files) if files > 1 else rows.coalesce(1)).write.mode("append").parquet(path)
        written += files
        while len(spark.read.schema(rows.schema).parquet(path).inputFiles()) < written:
            rows.limit(0).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.drop("_at").schema).option("maxFilesPerTrigger", files).parquet(path)


def event_pages(spark, folder) -> DataFrame:
    return sample.page_log(spark, sample.StreamFolder.of(folder, "events")).withWatermark("rowtime", "3 seconds")


@check("stream_unique_visitors", "SELECT seq, mid, page_id, ts_ms AS ts FROM uv")
def _(spark, folder):
    rows = through(spark, dwd.unique_visitors(event_pages(spark, folder)))
    return rows.select("seq", F.col("common.mid").alias("mid"), "page.page_id", "ts")


# what the watermark has passed at the end of the stream: the waiting time and the out-of-orderness before the last row
_DECIDED = "epoch_ms(ts) < (SELECT epoch_ms(max(ts)) FROM pv) - 21603000"


def page_files(spark, folder, turned: bool = False) -> DataFrame:
    pages = sample.page_log(spark, folder).withColumn("_at", F.unix_seconds("rowtime").cast("double"))
    return in_files(spark, pages, "_at", turned=turned)


def judged_stream(spark, folder) -> DataFrame:
    pages = page_files(spark, folder).withWatermark("rowtime", hold_delay(SIX_HOURS))
    rows = through(spark, dwd.judged_entries(pages, SIX_HOURS))
    return rows.select("seq", F.col("common.mid").alias("mid"), "kind")


@check(
    "stream_user_jumps",
    f"""SELECT seq, mid, CASE WHEN next_ts IS NULL OR next_ts - ts >= INTERVAL 6 HOUR THEN 'timeout' ELSE 'match' END AS kind
FROM uj WHERE {_DECIDED}""",
)
def _(spark, folder):
    return judged_stream(spark, folder)


@check("stream_timeouts", f"SELECT seq, mid FROM nx WHERE entry AND (next_ts IS NULL OR next_ts - ts >= INTERVAL 6 HOUR) AND {_DECIDED}")
def _(spark, folder):
    pages = page_files(spark, folder).withWatermark("rowtime", hold_delay(SIX_HOURS)).withColumn("mid", F.col("common.mid"))
    return through(spark, timeouts(pages, "mid", entry_page(), within_seconds=SIX_HOURS)).select("seq", "mid")


@check(
    "stream_new_visitor_repair",
    """SELECT seq, mid, CASE WHEN is_new = '1' AND CAST(ts AS DATE) <> origin THEN '0' ELSE is_new END AS is_new FROM (
  SELECT *, first_value(CASE WHEN is_new = '1' THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END)
    OVER (PARTITION BY mid ORDER BY ts, seq) AS origin FROM pv)""",
)
def _(spark, folder):
    rows = through(spark, dwd.repaired_log(event_pages(spark, folder)))
    return rows.select("seq", "common.mid", "common.is_new")


@check("stream_login_days", f"SELECT uid, {day('ts')} AS day, CAST(1 AS BIGINT) AS uu_ct, CAST(CASE WHEN d - last_d >= 3 THEN 1 ELSE 0 END AS BIGINT) AS back_ct FROM login_day")
def _(spark, folder):
    logins = event_pages(spark, folder).where(is_login()).select(F.col("common.uid").alias("uid"), "rowtime")
    rows = through(spark, login_days(logins, "uid", min_days=3))
    return rows.select("uid", times.day("rowtime").alias("day"), "uu_ct", "back_ct")


@check("stream_cart_adds", "SELECT id, user_id, sku_id, sku_num, source_type_code, source_type_name, ts FROM cart_add")
def _(spark, folder):
    log = sample.cart_info(spark, sample.StreamFolder.of(folder, "events"))
    return through(spark, dwd.cart_adds(log, lookups.dictionary(spark)))


@check(
    "stream_log_messages",
    """SELECT topic, count(*) AS n FROM (
  SELECT 'dwd_traffic_err_log' AS topic FROM good_lg WHERE has_err UNION ALL SELECT 'dwd_traffic_start_log' FROM good_lg WHERE is_start
  UNION ALL SELECT 'dwd_traffic_page_log' FROM good_lg WHERE NOT is_start UNION ALL SELECT 'dirty_data' FROM lg WHERE seq % 50 = 7
  UNION ALL SELECT 'dwd_traffic_display_log' FROM (SELECT unnest(range(1, n_displays + 1)) FROM good_lg WHERE NOT is_start)
  UNION ALL SELECT 'dwd_traffic_action_log' FROM (SELECT unnest(range(1, n_actions + 1)) FROM good_lg WHERE NOT is_start))
GROUP BY topic""",
)
def _(spark, folder):
    raw = sample.traffic_topic(spark, sample.StreamFolder.of(folder, "events"))
    return through(spark, dwd.log_messages(raw)).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@check(
    "stream_bounded_join",
    f"""SELECT od.id, od.sku_id, oi.order_status, {text('oi.sec_at')} AS oi_ts
FROM od JOIN oi ON od.order_id = oi.id AND abs(od.sec_at - oi.sec_at) <= 905""",
)
def _(spark, folder):
    lines = sample.order_detail(spark, sample.StreamFolder.of(folder, "lineitem")).withWatermark("event_time", "15 minutes")
    lines = lines.select(*cdc.fields("id", "order_id", "sku_id"), "event_time")
    orders = sample.order_info(spark, sample.StreamFolder.of(folder, "orders")).withWatermark("event_time", "15 minutes")
    orders = orders.select(cdc.field("id").alias("_o"), *cdc.fields("order_status"), F.col("ts").alias("oi_ts"), "event_time")
    return through(spark, bounded_join(lines, orders, {"order_id": "_o"}, ORDER_WAIT, alone=True)).drop("event_time", "order_id")


@check(
    "stream_window_versions",
    f"""SELECT {bounds('b', '1 HOUR')}, ch, CAST(sum(during_time) AS BIGINT) AS during_time FROM (
  SELECT date_trunc('hour', ts) AS b, ch, during_time FROM pv) GROUP BY b, ch""",
)
def _(spark, folder):
    views = event_pages(spark, folder).select(F.col("common.ch").alias("ch"), F.col("page.during_time").alias("during_time"), "rowtime")
    target = scratch(spark)
    table = VersionedTable(f"{target}/rows", ["stt", "edt", "ch"], ["stt", "edt", "ch", "during_time", "ts"])
    run_once(tumble(views, sums("during_time"), ["ch"], HOUR), table.append, f"{target}/checkpoint", "update")
    return table.read(spark).select("stt", "edt", "ch", "during_time")


@check(
    "stream_dimensions",
    f"""SELECT * FROM ({DIMENSION_CELLS})
UNION ALL SELECT 'dim_user_info', {text('c_custkey')}, unnest(['id','name']), unnest([{text('c_custkey')}, c_name]) FROM customer WHERE c_custkey % 2 = 0""",
)
def _(spark, folder):
    """The configuration changes between two micro-batches: brands are put into it, users are taken out of it.

    What comes before a table is configured, or after it no longer is, is dropped.
    """
    log = sample.dimension_log(spark, folder)
    even = F.col("data")["id"].cast("long") % 2 == 0
    later = (F.col("seq") > 3) | F.col("table").isin("base_province", "base_trademark") | ((F.col("table") == "user_info") & ~even)
    early = log.where("table = 'base_trademark'").withColumn("data", F.map_concat(F.map_filter("data", lambda k, v: k != "id"), F.create_map(F.lit("id"), F.lit("early"))))
    path = scratch(spark)
    for part in (log.where(~later).unionByName(early), log.where(later)):
        part.coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    in_force = iter(([1, 2, 5], [1, 2, 3, 4, 5, 6]))
    load = lambda s: sample.config_changes(s).where(F.col("seq").isin(next(in_force)))
    run_once(stream, dim.upsert_batch(load, f"{path}/dims", ddl=False), f"{path}/checkpoint")

    store = DimensionStore(f"{path}/dims")
    tables = {"dim_sku_info": SKU_COLUMNS, "dim_base_province": ["id", "name", "region_id"], "dim_base_trademark": ["id", "tm_name"], "dim_user_info": ["id", "name"]}
    cells = [
        store.read(spark, name, "id", columns).select(F.lit(name).alias("sink_table"), F.col("id").alias("pk"), F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])).alias("column", "value"))
        for name, columns in tables.items()
    ]
    return union_all(*cells)

"""A stream cut into files gives the rows of the same table read at once."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows_of
from millrace.functions import times
from millrace.operators import changes
from millrace.operators.joins import bounded_join
from millrace.operators.visitors import first_per_day
from millrace.operators.windows import tumble, tumble_distinct
from millrace.plans import dwd, dws
from millrace.sinks.tables import VersionedTable
from millrace.sources import lookups, sample
from millrace.streaming.runner import late_rows, run_once, start, state_size
from millrace.streaming.stateful import BUCKETS, PROCESSING, SETTLE_SECONDS, flag_first_per_day, hold_delay, settle_latest

FAR = datetime.datetime(2031, 1, 1)


def cut(df, order, n):
    """``n`` parts in the order of ``order`` (seconds)."""
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    step = (hi - lo) / n + 1
    return [df.where((F.col(order) >= lo + i * step) & (F.col(order) < lo + (i + 1) * step)) for i in range(n)]


def pages_in_parts(spark, n=3):
    pages = sample.page_log(spark, SMALL).withColumn("_sec", F.unix_seconds("rowtime"))
    parts = cut(pages, "_sec", n)
    far = parts[-1].limit(1).withColumns(
        {
            "rowtime": F.lit(FAR),
            "seq": F.lit(10**9).cast("long"),
            "_sec": F.lit(0).cast("long"),
            "common": F.col("common").withField("mid", F.lit("far")).withField("uid", F.lit("far")),
            "page": F.col("page").withField("page_id", F.lit("home")).withField("last_page_id", F.lit("")),
        }
    )
    return [p.drop("_sec") for p in parts], far.drop("_sec")


@pytest.fixture(scope="module")
def pages(spark):
    return sample.page_log(spark, SMALL)


def test_unique_visitors(spark, stream_of, drain, pages):
    parts, _ = pages_in_parts(spark)
    got, _ = drain(dwd.unique_visitors(stream_of(*parts).withWatermark("rowtime", "3 seconds")))
    assert rows_of(got, "seq") == rows_of(dwd.unique_visitors(pages), "seq")
    assert got.dtypes == pages.dtypes


def test_new_visitor_repair(spark, stream_of, drain, pages):
    parts, _ = pages_in_parts(spark)
    got, _ = drain(dwd.repaired_log(stream_of(*parts)))
    want = dwd.repaired_log(pages)
    assert rows_of(got, "seq", "common.is_new", "page.page_id", "rowtime") == rows_of(want, "seq", "common.is_new", "page.page_id", "rowtime")
    assert got.where("common.is_new = '0'").count() > pages.where("common.is_new = '0'").count()


def test_bounces(spark, stream_of, drain, pages):
    parts, far = pages_in_parts(spark)
    hours = 6 * 3600
    stream = stream_of(*parts, far).withWatermark("rowtime", hold_delay(hours))
    got, _ = drain(dwd.user_jumps(stream, hours))
    assert rows_of(got.where("seq < 1000000000"), "seq") == rows_of(dwd.user_jumps(pages, hours), "seq")


def test_logins(spark, stream_of, drain, pages):
    parts, far = pages_in_parts(spark)
    stream = stream_of(*parts, far).withWatermark("rowtime", "3 seconds")
    got, _ = drain(dws.user_logins(stream, "1 day", F.lit(0), min_days=3))
    want = rows_of(dws.user_logins(pages, "1 day", F.lit(0), min_days=3))
    assert rows_of(got.where("stt < '2030'")) == want
    assert sum(r[2] for r in want) > 0


def test_home_and_detail_views(spark, stream_of, drain, pages):
    parts, far = pages_in_parts(spark)
    stream = stream_of(*parts, far).withWatermark("rowtime", "3 seconds")
    got, _ = drain(dws.home_detail_views(stream, "1 hour", F.lit(0)))
    assert rows_of(got.where("stt < '2030'")) == rows_of(dws.home_detail_views(pages, "1 hour", F.lit(0)))


def test_page_views_of_three_streams(spark, stream_of, drain, pages):
    """Each input has its own watermark; the bounces, which come late, hold the others back."""
    hours = 6 * 3600
    parts, far = pages_in_parts(spark)
    inputs = [pages, dwd.unique_visitors(pages), dwd.user_jumps(pages, hours)]
    streams = []
    for df in inputs:
        sec = df.withColumn("_sec", F.unix_seconds("rowtime"))
        streams.append(stream_of(*[p.drop("_sec") for p in cut(sec, "_sec", 2)], far).withWatermark("rowtime", "3 seconds"))
    got, query = drain(dws.page_views(*streams, "1 hour", F.lit(0)))
    assert rows_of(got.where("stt < '2030'")) == rows_of(dws.page_views(*inputs, "1 hour", F.lit(0)))
    assert late_rows(query) == 0


def test_keyword_views(spark, stream_of, drain):
    pages = sample.page_log(spark, SMALL, items=True)
    _, far = pages_in_parts(spark)
    sec = pages.withColumn("_sec", F.unix_seconds("rowtime"))
    parts = [p.drop("_sec") for p in cut(sec, "_sec", 2)]
    # only rows that pass the filters move the watermark on, so the far row is a search
    far = far.withColumn("page", F.col("page").withField("last_page_id", F.lit("search")).withField("item", F.lit("far")))
    stream = stream_of(*parts, far.select(*pages.columns)).withWatermark("rowtime", "3 seconds")
    got, _ = drain(dws.keyword_views(stream, "1 hour", F.lit(0)))
    assert rows_of(got.where("keyword <> 'far'")) == rows_of(dws.keyword_views(pages, "1 hour", F.lit(0)))


def facts_in_parts(spark, n=3):
    facts = sample.order_facts(spark, SMALL).withColumn("seq", F.expr("CAST(seq.l_partkey * 100000 + seq.l_suppkey AS BIGINT)"))
    facts = facts.withColumn("rowtime", F.timestamp_seconds("ts"))
    parts = cut(facts, "ts", n)
    far = parts[-1].limit(1).withColumns({"rowtime": F.lit(FAR), "id": F.lit("far"), "user_id": F.lit("far"), "sku_id": F.lit("far")})
    return facts, parts, far


def test_province_orders_with_duplicates(spark, stream_of, drain):
    """Versions of a line lie in one micro-batch; the settled latest one is counted."""
    facts, parts, far = facts_in_parts(spark)
    stream = stream_of(*parts, far, far.withColumn("rowtime", F.lit(FAR + datetime.timedelta(days=9)))).withWatermark("rowtime", hold_delay(SETTLE_SECONDS))
    provinces = sample.provinces(spark, SMALL)
    got, _ = drain(dws.province_orders(stream, provinces, now=F.lit(0)))
    assert rows_of(got.where("stt < '2030'")) == rows_of(dws.province_orders(facts, provinces, now=F.lit(0)))


def test_sku_orders(spark, stream_of, drain):
    facts, parts, far = facts_in_parts(spark)
    later = far.withColumns({"rowtime": F.lit(FAR + datetime.timedelta(days=9)), "id": F.lit("far2")})
    stream = stream_of(*parts, far, later).withWatermark("rowtime", hold_delay(SETTLE_SECONDS))
    dims = sample.sku_dims(spark, SMALL)
    got, _ = drain(dws.sku_orders(stream, dims, now=F.lit(0)))
    want = dws.sku_orders(facts, dims, now=F.lit(0))
    assert rows_of(got.where("stt < '2030'")) == rows_of(want)


def test_arrival_by_the_column_type(spark, stream_of, drain):
    """Rows of one time are told apart by ``seq`` as on tables: text as text, numbers as numbers, structs field by field."""
    at = datetime.datetime(2024, 1, 1, 8)
    rows = spark.createDataFrame([(at, "a", 9, "x"), (at, "a", 10, "y"), (at, "b", None, "z"), (at, "b", 1, "w")], "rowtime timestamp, k string, n long, v string")
    for seq in (F.col("n"), F.col("n").cast("string"), F.struct("n", "v")):
        typed = rows.withColumn("seq", seq)
        got, _ = drain(first_per_day(stream_of(typed).withWatermark("rowtime", "1 second"), "k"))
        assert rows_of(got, "k", "v") == rows_of(first_per_day(typed, "k"), "k", "v")


def test_exact_distinct_in_one_query(spark, stream_of, drain):
    facts, parts, far = facts_in_parts(spark)
    got, _ = drain(tumble_distinct(stream_of(*parts, far).withWatermark("rowtime", "3 seconds"), ["province_id"], "order_id", "n", [], "1 day", now=F.lit(0)))
    want = tumble_distinct(facts, ["province_id"], "order_id", "n", [], "1 day", now=F.lit(0))
    assert rows_of(got.where("stt < '2030'")) == rows_of(want)


def test_cart_users(spark, stream_of, drain):
    dic = lookups.dictionary(spark)
    carts = dwd.cart_adds(sample.cart_info(spark, SMALL), dic)
    carts = carts.withColumn("seq", F.col("id").cast("long")).withColumn("rowtime", times.from_seconds("ts"))
    sec = carts.withColumn("_sec", F.unix_seconds("rowtime"))
    far = carts.limit(1).withColumns({"rowtime": F.lit(FAR), "user_id": F.lit("far")})
    stream = stream_of(*[p.drop("_sec") for p in cut(sec, "_sec", 3)], far).withWatermark("rowtime", "3 seconds")
    got, _ = drain(dws.cart_users(stream, "1 hour", F.lit(0)))
    assert rows_of(got.where("stt < '2030'")) == rows_of(dws.cart_users(carts, "1 hour", F.lit(0)))


def test_cart_adds_with_static_dictionary(spark, stream_of, drain):
    dic = lookups.dictionary(spark)
    log = sample.cart_info(spark, SMALL)
    sec = log.withColumn("_sec", F.unix_seconds("event_time"))
    got, _ = drain(dwd.cart_adds(stream_of(*[p.drop("_sec") for p in cut(sec, "_sec", 2)]), dic))
    assert rows_of(got) == rows_of(dwd.cart_adds(log, dic))


def test_order_pre_process_of_streams(spark, stream_of, drain):
    """Inner and left outer joins with a bounded wait, in one query."""
    dic = lookups.dictionary(spark)
    log = sample.change_log(spark, SMALL, "order_detail", "order_info", "order_detail_activity", "order_detail_coupon")
    log = log.where(F.coalesce(F.col("data")["order_id"], F.col("data")["id"], F.expr("data['order_detail_id'] div 10")).cast("long") % 10 < 9).persist()
    sec = log.withColumn("_sec", F.unix_seconds("event_time"))
    far = [
        log.where(F.col("table") == t).limit(1).withColumn("event_time", F.lit(FAR)).withColumn("data", F.map_concat(F.map_filter("data", lambda k, v: ~k.isin("id", "order_detail_id")), F.create_map(F.lit(k), F.lit("far"))))
        for t, k in [("order_detail", "id"), ("order_info", "id"), ("order_detail_activity", "order_detail_id"), ("order_detail_coupon", "order_detail_id")]
    ]
    far = far[0].unionByName(far[1]).unionByName(far[2]).unionByName(far[3])
    later = far.withColumn("event_time", F.lit(FAR + datetime.timedelta(days=1)))
    stream = stream_of(*[p.drop("_sec") for p in cut(sec, "_sec", 2)], far, later).withWatermark("event_time", "15 minutes")
    got, _ = drain(dwd.order_pre_process(stream, dic).drop("old", "row_op_ts"))
    want = dwd.order_pre_process(log, dic).drop("old", "row_op_ts")
    assert rows_of(got.where("id <> 'far'")) == rows_of(want)
    log.unpersist()


def test_restart_on_the_same_checkpoint(spark, tmp_path, pages):
    parts, _ = pages_in_parts(spark, 2)
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    seen = []

    def keep(batch, batch_id):
        seen.extend(r.seq for r in batch.select("seq").collect())

    for part in parts:
        part.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(part.schema).parquet(folder).withWatermark("rowtime", "3 seconds")
        run_once(dwd.unique_visitors(stream), keep, checkpoint)
    assert sorted(seen) == sorted(r.seq for r in dwd.unique_visitors(pages).select("seq").collect())


def test_order_of_files_within_the_watermark(spark, stream_of, drain, pages):
    """Files may arrive in any order as long as they lie within the watermark."""
    parts, _ = pages_in_parts(spark, 3)
    stream = stream_of(parts[1], parts[0], parts[2]).withWatermark("rowtime", "60 days")
    days = dwd.unique_visitors(stream)
    got, _ = drain(days)
    key = [F.col("common.mid").alias("mid"), times.day("rowtime").alias("day")]
    assert rows_of(got.select(*key)) == rows_of(dwd.unique_visitors(pages).select(*key))


def test_updated_windows_replace_each_other(spark, stream_of, tmp_path, pages):
    """In update mode every micro-batch writes a new version of the open windows; the read keeps the last."""
    parts, _ = pages_in_parts(spark, 3)
    keys, columns = ["stt", "edt"], ["stt", "edt", "n", "ts"]
    table = VersionedTable(str(tmp_path / "summary"), keys, columns)

    def count(df):
        return tumble(df, [F.count(F.lit(1)).alias("n")], None, "20 days", now=None)

    run_once(count(stream_of(*parts).withWatermark("rowtime", "3 seconds")), table.append, str(tmp_path / "checkpoint"), "update")
    assert table.versions(spark).count() > table.read(spark).count()
    assert rows_of(table.read(spark), "stt", "edt", "n") == rows_of(count(pages), "stt", "edt", "n")


def test_flagging_keeps_all_rows(spark, stream_of, drain, pages):
    parts, _ = pages_in_parts(spark, 2)
    rows = stream_of(*parts).withWatermark("rowtime", "3 seconds").where(changes.entry_page()).withColumn("mid", F.col("common.mid"))
    got, _ = drain(flag_first_per_day(rows, ["mid"], "rowtime", "seq"))
    assert got.count() == pages.where(changes.entry_page()).count()
    assert rows_of(got.where("first = 1"), "seq") == rows_of(dwd.unique_visitors(pages), "seq")


def test_late_rows_are_dropped_and_counted(spark, stream_of, drain):
    make = lambda *secs: spark.createDataFrame([(s,) for s in secs], "sec long").select(F.timestamp_seconds("sec").alias("rowtime"))
    # a watermark that a micro-batch finds applies to late rows two micro-batches on
    stream = stream_of(make(100, 101), make(200), make(205), make(102), make(300)).withWatermark("rowtime", "3 seconds")
    got, query = drain(tumble(stream, [F.count(F.lit(1)).alias("n")], now=F.lit(0)))
    assert rows_of(got, "stt", "n") == [("1970-01-01 00:01:40", 2), ("1970-01-01 00:03:20", 2)]
    assert late_rows(query) == 1


def test_join_by_buckets(spark, stream_of, drain):
    """An inner join that nothing stateful follows keeps an entry for a bucket, not one for a row: same rows as Spark's own join of
    streams, with late rows, rows without a key or a time, a busy key, partners in other micro-batches and a last row far away."""

    def side(own, *parts):
        schema = "k string, d int, s long, v string, n long, w array<int>"
        make = lambda rows: spark.createDataFrame(rows, schema).select("k", "d", "v", "n", "w", F.timestamp_micros("s").alias("event_time"))
        df = stream_of(*map(make, parts)).withWatermark("event_time", "20 seconds")
        return df if own else df.withColumnsRenamed({"k": "k2", "d": "d2", "v": "v2", "n": "n2", "w": "w2"})

    def row(k, at, v, d=1):
        return (k, d, None if at is None else int(at * 1_000_000), v, None if v == "none" else int(at or 0), [1, None] if v else None)

    far = 10_000_000
    busy = [row("busy", 1000 + i % 40, f"b{i}") for i in range(300)]
    lefts = [
        [row("a", 1000, "a0"), row("a", 1000.000001, None), row("b", 1010, "none"), row(None, 1000, "x"), row("c", None, "x"), row("é \"", 1000, "quoted", None), *busy],
        [row("a", 1100, "a1"), row("é \"", 1100, "quoted")],
        [row("a", 1005, "late"), row("b", 1020, "b2")],
        [row("a", 1006, "later"), row("a", 1300, "a2")],
        [row("far", far, "far")],
        [row("far", far + 1000, "far")],
    ]
    rights = [
        [row("a", 1010, "x"), row("a", 1010.000001, "y"), row("b", 1000, "z", 2), *busy[:50]],
        [row("a", 1090, None), row("é \"", 1105, "q"), row("b", 1025, "w")],
        [row("b", 1018, "v"), row("a", 1108, "u"), row(None, 1100, "x")],
        [row("a", 1290, "t"), row("a", 1004, "late")],
        [row("far", far + 5, "far")],
        [row("far", far + 1000, "far")],
    ]
    for on, wait in (({"k": "k2"}, 10), ({"n": "n2", "d": "d2"}, 0)):
        found = []
        for alone in (False, True):
            got, query = drain(bounded_join(side(True, *lefts), side(False, *rights), on, wait, alone=alone))
            found.append((rows_of(got), got.dtypes, state_size(query)["rows"], late_rows(query) > 0))
        spark_join, ours = found
        assert ours[:2] == spark_join[:2] and len(ours[0]) > 100
        assert ours[2] <= 1 and ours[3] == spark_join[3] is True
    joined = bounded_join(side(True, *lefts), side(False, *rights), {"k": "k2"}, 10, "left_outer", alone=True)
    assert "StateTimeout" not in joined._jdf.queryExecution().toString()


def until(found, query, seconds=90):
    """Wait for a running stream's result, then stop it."""
    try:
        end = time.time() + seconds
        while not found() and time.time() < end and query.exception() is None:
            time.sleep(0.5)
        assert query.exception() is None
        assert found()
    finally:
        query.stop()


def test_kinds_of_bounces(spark, stream_of, drain, pages):
    """Matches and time-outs come out of one pass, on the table and on the stream."""
    parts, far = pages_in_parts(spark)
    hours = 6 * 3600
    got, _ = drain(dwd.judged_entries(stream_of(*parts, far).withWatermark("rowtime", hold_delay(hours)), hours))
    want = dwd.judged_entries(pages, hours)
    assert rows_of(got.where("seq < 1000000000"), "seq", "kind") == rows_of(want, "seq", "kind")
    assert {r.kind for r in want.select("kind").distinct().collect()} == {"match", "timeout"}


def visits(spark, *rows):
    return spark.createDataFrame([(s, m, None if t is None else datetime.datetime.fromtimestamp(t, datetime.UTC), v) for s, m, t, v in rows], "seq long, mid string, rowtime timestamp, v string")


def test_rows_without_a_time(spark, stream_of, drain):
    """No time, no visit: bounces and logins leave such a row out, first visits give it a day of its own, on tables and streams."""
    from millrace.operators.bounce import verdicts
    from millrace.operators.visitors import first_per_day, login_days

    table = visits(spark, (1, "a", 100, ""), (2, "a", None, ""), (3, "b", None, None), (4, "a", 105, "home"), (5, "b", 200, ""))
    far = visits(spark, (9, "far", 10_000_000, "home"))
    jobs = {
        "verdicts": lambda d: verdicts(d, "mid", F.coalesce("v", F.lit("")) == "", within_seconds=10).select("seq", "kind"),
        "first": lambda d: first_per_day(d, "mid").select("seq"),
        "login": lambda d: login_days(d, "mid").select("mid", "rowtime"),
    }
    for name, job in jobs.items():
        got, _ = drain(job(stream_of(table, far).withWatermark("rowtime", "13 seconds")), name=name)
        assert [r for r in rows_of(got) if r[0] not in (9, "far")] == [r for r in rows_of(job(table))]
    assert rows_of(jobs["verdicts"](table)) == [(5, "timeout")]


def test_first_visits_by_the_clock_lose_no_late_row(spark, stream_of, tmp_path):
    """The last file comes first and no watermark is set: each visitor and day still gives exactly one row."""
    pages = sample.page_log(spark, SMALL)
    parts, _ = pages_in_parts(spark, 3)
    nowhere = parts[0].limit(1).withColumn("rowtime", F.lit(None).cast("timestamp")).withColumn("page", F.col("page").withField("last_page_id", F.lit("")))
    stream = dwd.unique_visitors(stream_of(*parts[::-1], nowhere), clock=PROCESSING)
    seen = []
    query = start(stream.select(F.col("common.mid").alias("mid"), times.day("rowtime").alias("day")), lambda b, _: seen.extend(map(tuple, b.collect())), str(tmp_path / "c"), every="1 second")
    want = {(r.mid, r.day) for r in dwd.unique_visitors(pages).select(F.col("common.mid").alias("mid"), times.day("rowtime").alias("day")).collect()}
    until(lambda: len(seen) > len(want), query)
    assert len(seen) == len(set(seen)) and want == {s for s in seen if s[1] is not None} and sum(s[1] is None for s in seen) == 1


def test_settling_by_the_clock(spark, stream_of, tmp_path):
    """Versions wait for some seconds of real time; one that comes later than all watermarks still counts."""
    make = lambda *rows: spark.createDataFrame(rows, "id string, seq long, version string, sec long").select(
        "id", "seq", "version", F.timestamp_seconds("sec").alias("rowtime")
    )
    stream = stream_of(make(("a", 1, "2024-01-01 00:00:02", 9000), ("b", 2, None, 9000)), make(("a", 3, "2024-01-01 00:00:01", 5)), make(("a", 4, "2024-01-01 00:00:02", 7), ("c", 5, "x", None)))
    seen = []
    query = start(settle_latest(stream, ["id"], "version", "seq", clock=PROCESSING, seconds=20), lambda b, _: seen.extend((r.id, r.seq) for r in b.collect()), str(tmp_path / "c"), every="1 second")
    until(lambda: len(seen) >= 3, query)
    assert sorted(seen) == [("a", 4), ("b", 2), ("c", 5)]


def timers(query):
    """Timers that the micro-batches of a query have set."""
    return sum(op["customMetrics"].get("numRegisteredTimers", 0) for p in query.recentProgress for op in p["stateOperators"])


def many_visits(spark, n=6000):
    at = F.timestamp_seconds(F.lit(1_704_100_000) + F.col("id") % 3000)
    return spark.range(n).select(F.col("id").alias("seq"), (F.col("id") % (n // 2)).cast("string").alias("mid"), at.alias("rowtime"), F.lit("").alias("v"))


def test_first_visits_share_state_calls(spark, stream_of, drain):
    """A day's visitors are kept by bucket, so their number doesn't set the number of calls to the state."""
    rows = many_visits(spark)
    got, query = drain(first_per_day(stream_of(rows.where("seq < 4000"), rows.where("seq >= 4000")).withWatermark("rowtime", "1 hour"), "mid"))
    assert rows_of(got, "seq") == rows_of(first_per_day(rows, "mid"), "seq")
    assert 0 < timers(query) <= BUCKETS


def test_bounces_share_state_calls(spark, stream_of, drain):
    from millrace.operators.bounce import verdicts

    rows, far = many_visits(spark), visits(spark, (10**9, "far", 1_800_000_000, "home"))
    job = lambda d: verdicts(d, "mid", F.col("v") == "", within_seconds=3600).select("seq", "kind")
    got, query = drain(job(stream_of(rows, far).withWatermark("rowtime", hold_delay(3600))))
    assert rows_of(got) == rows_of(job(rows))
    assert 0 < timers(query) <= 2 * BUCKETS + 2


def test_repair_sees_only_what_it_needs(spark, stream_of, drain):
    """Rows without a time never reach the state, those that can't change pass beside it, ties follow ``seq``."""
    from millrace.operators.visitors import repair_new_visitor

    day = 86_400
    rows = visits(spark, (1, "a", 5 * day, "1"), (2, "a", 5 * day, "0"), (3, "a", None, "1"), (4, None, None, None), (5, None, 6 * day, "1"), (6, "b", 5 * day, None), (7, "b", 6 * day, "1"), (8, None, 7 * day, "1"))
    for seq in (F.col("seq"), F.struct((-F.col("seq")).alias("n"), F.col("v").alias("v"))):
        typed = rows.withColumn("id", F.col("seq")).withColumn("seq", seq)
        job = lambda d: repair_new_visitor(d, "mid", "v", out="fixed").select("id", "v", "fixed", "rowtime")
        stream = stream_of(typed.where("id < 7"), typed.where("id >= 7"))
        got, _ = drain(job(stream))
        assert rows_of(got) == rows_of(job(typed))
    plan = job(stream)._jdf.queryExecution().analyzed().toString()
    assert "Union" in plan and "isnotnull(rowtime" in plan


def test_micro_batches_of_several_files(spark, monkeypatch):
    """A micro-batch of many rows is written and read by several tasks, and still is one part of the time."""
    from checks import streams

    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    want = rows_of(streams.judged_stream(spark, SMALL))
    pages = sample.page_log(spark, SMALL).withColumn("_at", F.when(F.col("seq") < 900, 0.0).otherwise(F.col("seq").cast("double")))
    stream = streams.in_files(spark, pages, "_at")
    sizes = []
    run_once(stream, lambda b, _: sizes.append((b.count(), b.select(F.spark_partition_id()).distinct().count())), streams.scratch(spark) + "/c")
    assert sum(n for n, _ in sizes) == pages.count() and len(sizes) == 4
    monkeypatch.setattr(streams, "FILE_ROWS", 10**9)
    assert want == rows_of(streams.judged_stream(spark, SMALL))

"""The rules of single operators on a few rows each."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from millrace.functions import cdc, text, times, values
from millrace.operators import bounce, changes, dedup, enrich, joins, routing, visitors
from millrace.operators.windows import tumble
from millrace import schemas
from millrace.plans import ads, dim, dwd
from millrace.sinks import dimensions, external, tables
from millrace.sources import lookups, topics
from millrace.streaming.runner import run_once


def at(text):
    return text and datetime.datetime.fromisoformat(text)


def visits(spark, *rows):
    """(seq, key, time, last page or flag)"""
    return spark.createDataFrame([(s, k, at(t), v) for s, k, t, v in rows], "seq long, mid string, rowtime timestamp, v string")


def test_new_visitor_repair(spark):
    rows = visits(
        spark,
        (1, "a", "2024-01-01 08:00:00", "1"),
        (2, "a", "2024-01-01 09:00:00", "1"),
        (3, "a", "2024-01-02 09:00:00", "1"),
        (4, "a", "2024-01-03 09:00:00", "0"),
        (5, "b", "2024-01-01 00:00:00", "0"),
        (6, "b", "2024-01-01 10:00:00", "1"),
        (7, "c", "2024-01-05 10:00:00", "1"),
    )
    got = visitors.repair_new_visitor(rows, "mid", "v", out="fixed")
    assert rows_of(got, "seq", "fixed") == [(1, "1"), (2, "1"), (3, "0"), (4, "0"), (5, "0"), (6, "0"), (7, "1")]
    odd = visits(
        spark,
        (1, None, "2024-01-01 08:00:00", None),
        (2, None, "2024-01-02 08:00:00", "1"),
        (3, "a", None, "1"),
        (4, "a", "2024-01-01 08:00:00", "1"),
        (4, "a", "2024-01-01 08:00:00", "1"),
        (5, "a", "2024-01-02 08:00:00", None),
        (6, "b", None, "1"),
    )
    got = visitors.repair_new_visitor(odd, "mid", "v", out="fixed")
    assert got.columns == [*odd.columns, "fixed"]
    assert rows_of(got, "seq", "fixed") == [(1, None), (2, "0"), (3, "1"), (4, "1"), (4, "1"), (5, None), (6, "1")]
    assert rows_of(visitors.repair_new_visitor(odd.limit(0), "mid", "v")) == []


def test_first_of_day(spark):
    rows = visits(
        spark,
        (1, "a", "2024-01-01 23:00:00", ""),
        (2, "a", "2024-01-01 08:00:00", None),
        (3, "a", "2024-01-02 00:00:00", ""),
        (4, "a", "2024-01-01 07:00:00", "home"),
        (5, "b", "2024-01-01 08:00:00", None),
        (6, "b", "2024-01-01 08:00:00", ""),
    )
    got = visitors.first_per_day(rows.where(values.is_blank("v")), "mid")
    assert rows_of(got, "seq") == [(2,), (3,), (5,)]


@pytest.mark.parametrize(
    "follow, want",
    [
        ([], [1]),
        ([(2, 3, "")], [1, 2]),
        ([(2, 3, "home")], []),
        ([(2, 10, "home")], [1]),
        ([(2, 9, "home")], []),
        ([(2, 11, "home")], [1]),
        ([(2, 0, "home")], []),
        ([(2, 0, "")], [1, 2]),
        ([(2, 1, ""), (3, 2, None)], [1, 2, 3]),
        ([(2, 1, ""), (3, 2, "home")], [1]),
    ],
)
def test_bounces(spark, follow, want):
    for start in ("2024-01-01 00:00:00", "2024-01-01 00:04:57"):  # the second one runs over the end of a slice
        begin = at(start)
        rows = [(1, "a", begin, "")] + [(s, "a", begin + datetime.timedelta(seconds=d), v) for s, d, v in follow]
        df = spark.createDataFrame(rows, "seq long, mid string, rowtime timestamp, v string")
        assert [r[0] for r in rows_of(bounce.bounces(df, "mid", values.is_blank("v")), "seq")] == want


def test_latest_version(spark):
    rows = spark.createDataFrame(
        [
            ("a", 1, "2022-09-14 02:05:30.08Z", "old"),
            ("a", 2, "2022-09-14 02:05:30.085Z", "new"),
            ("b", 1, "2022-09-14 02:05:30Z", "first"),
            ("b", 2, "2022-09-14 02:05:30Z", "second"),
            ("c", 1, "2022-09-14 02:05:30Z", None),
            ("c", 2, "2022-09-14 02:05:31Z", "complete"),
        ],
        "id string, seq long, v string, x string",
    )
    rows = rows.unionByName(spark.createDataFrame([("d", 1, "2022-09-14 02:05:30Z", "dated"), ("d", 2, "no time", "x"), ("d", 3, None, "y")], rows.schema))
    for version in (times.version_time("v"), F.col("v")):  # as time and as text
        got = dedup.latest_version(rows.withColumn("row_op_ts", version), ["id"], "row_op_ts", "seq")
        assert rows_of(got, "id", "x") == [("a", "new"), ("b", "second"), ("c", "complete"), ("d", "dated")]


def test_returns_after_eight_days(spark):
    rows = visits(
        spark,
        (1, "a", "2024-01-01 23:00:00", ""),
        (2, "a", "2024-01-08 01:00:00", ""),
        (3, "b", "2024-01-01 23:59:59", ""),
        (4, "b", "2024-01-09 00:00:00", ""),
        (5, "c", "2024-01-01 00:00:00", ""),
        (6, "c", "2024-01-08 23:59:59", ""),
        (7, "c", "2024-01-08 12:00:00", ""),
    )
    got = visitors.login_days(rows, "mid")
    assert rows_of(got.groupBy("mid").agg(F.sum("uu_ct"), F.sum("back_ct"))) == [("a", 2, 0), ("b", 2, 1), ("c", 2, 0)]


def change(spark, *rows):
    schema = "database string, table string, type string, ts string, old map<string,string>, data map<string,string>"
    df = spark.createDataFrame([("shop", *r) for r in rows], schema)
    return df.withColumn("event_time", times.from_seconds("ts"))


def test_cart_changes(spark):
    row = lambda i, num, source="2401": {"id": i, "user_id": "u", "sku_id": "s", "sku_num": num, "source_type": source}
    log = change(
        spark,
        ("cart_info", "insert", "1", None, row("1", "2")),
        ("cart_info", "update", "1", {"sku_num": "2"}, row("2", "5")),
        ("cart_info", "update", "1", {"sku_num": "5"}, row("3", "2")),
        ("cart_info", "update", "1", {"source_type": "x"}, row("4", "9")),
        ("cart_info", "update", "1", {"sku_num": "abc"}, row("5", "9")),
        ("cart_info", "update", "1", {"sku_num": None}, row("6", "9")),
        ("cart_info", "insert", "1", None, row("7", "1", "9999")),
        ("order_info", "insert", "1", None, row("8", "1")),
    )
    got = dwd.cart_adds(log, lookups.dictionary(spark))
    assert got.columns == schemas.CART_ADD
    assert rows_of(got, "id", "sku_num", "source_type_name") == [("1", "2", "search"), ("2", "3", "search")]


def test_status_transition(spark):
    log = change(
        spark,
        ("order_info", "update", "1", {"order_status": "1001"}, {"id": "1", "order_status": "1003"}),
        ("order_info", "update", "1", {"operate_time": "x"}, {"id": "2", "order_status": "1003"}),
        ("order_info", "insert", "1", None, {"id": "3", "order_status": "1003"}),
        ("order_info", "update", "1", {"order_status": "1001"}, {"id": "4", "order_status": "1002"}),
    )
    assert rows_of(log.where(cdc.transitioned("order_status", "1003")).select(cdc.field("id"))) == [("1",)]


def test_order_pre_process(spark):
    line = lambda i, source="2401": {"id": i, "order_id": "9", "sku_num": "2", "order_price": "8197.00", "source_type": source, "create_time": "2022-09-01 10:05:28"}
    log = change(
        spark,
        ("order_detail", "insert", "1000", None, line("1")),
        ("order_detail", "insert", "1000", None, line("2")),
        ("order_detail", "insert", "1000", None, line("3", "0000")),
        ("order_info", "insert", "1000", None, {"id": "9", "order_status": "1001", "operate_time": "2022-09-01 10:05:28"}),
        ("order_info", "update", "1905", {"order_status": "1001"}, {"id": "9", "order_status": "1003", "operate_time": "2022-09-02 10:05:28"}),
        ("order_info", "update", "1906", {"order_status": "1003"}, {"id": "9", "order_status": "1004"}),
        ("order_detail_activity", "insert", "1001", None, {"order_detail_id": "1", "activity_id": "a", "activity_rule_id": "r"}),
        ("order_detail_coupon", "insert", "2000", None, {"order_detail_id": "1", "coupon_id": "late"}),
    )
    pre = dwd.order_pre_process(log, lookups.dictionary(spark))
    assert pre.columns == schemas.ORDER_PRE_PROCESS and len(pre.columns) == 27
    got = rows_of(pre, "id", "order_status", "split_original_amount", "activity_id", "coupon_id", "date_id", "operate_date_id")
    assert got == [
        ("1", "1001", "16394.0000", "a", None, "2022-09-01", "2022-09-01"),
        ("1", "1003", "16394.0000", "a", None, "2022-09-01", "2022-09-02"),
        ("2", "1001", "16394.0000", None, None, "2022-09-01", "2022-09-01"),
        ("2", "1003", "16394.0000", None, None, "2022-09-01", "2022-09-02"),
    ]
    details, cancels = dwd.order_details(pre), dwd.order_cancels(pre)
    assert details.columns == schemas.ORDER_DETAIL and cancels.columns == schemas.ORDER_CANCEL_DETAIL
    assert rows_of(details, "id", "ts") == [("1", "1000"), ("2", "1000")]
    assert rows_of(cancels, "id", "date_id", "ts") == [("1", "2022-09-02", "1905"), ("2", "2022-09-02", "1905")]


def test_activities_of_lines_whose_ids_repeat(spark):
    """A line id in two orders, twice in one of them, or missing: each line has each activity of its id once."""
    line = lambda i, order, sku: ("order_detail", "insert", "1000", None, {"id": i, "order_id": order, "sku_id": sku, "source_type": "2401"})
    activity = lambda i, rule: ("order_detail_activity", "insert", "1001", None, {"order_detail_id": i, "activity_rule_id": rule})
    order = lambda i: ("order_info", "insert", "1000", None, {"id": i, "order_status": "1001"})
    lines = [line("1", "8", "a"), line("1", "8", "b"), line("1", "9", "c"), line(None, "9", "d"), line("2", "9", "e"), line("3", None, "f"), line("4", "7", "g")]
    log = change(spark, *lines, order("8"), order("9"), activity("1", "x"), activity("1", "y"), activity(None, "z"), activity("3", "x"))
    got = rows_of(dwd.order_pre_process(log, lookups.dictionary(spark)), "sku_id", "activity_rule_id")
    assert got == sorted([*[(sku, rule) for sku in "abc" for rule in "xy"], ("d", None), ("e", None)], key=repr)


def shuffled(spark, name):
    """The columns of every shuffle that a registered query plans where only the dictionary is broadcast."""
    from checks import CATALOG

    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
        plan = CATALOG[name].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    return [set(re.findall(r"(\w+)#\d+", columns)) for columns in re.findall(r"\) Exchange *\nInput \[\d+\]: \[(.*)\]", plan)]


@pytest.mark.parametrize("name", ["q6_order_pre_process", "q7_order_details", "q9_payments"])
def test_wide_order_lines_stay_where_their_order_is(spark, name):
    """Lines are shuffled as they come from the table, and not with all their text for each join."""
    found = shuffled(spark, name)
    assert any("l_partkey" in columns for columns in found) and not [columns for columns in found if "sku_id" in columns]


def test_order_lines_of_products_are_shuffled_once_per_key(spark):
    """Customers join orders, not lines; a product's summary rows already lie as its dimension is joined."""
    found = shuffled(spark, "q17_sku_orders")
    assert any("l_partkey" in columns for columns in found)
    assert not [columns for columns in found if {"l_partkey", "o_custkey"} <= columns or "stt" in columns]


def test_refunds(spark):
    log = change(
        spark,
        ("order_refund_info", "insert", "100", None, {"id": "r1", "order_id": "1", "sku_id": "s", "refund_type": "1501", "refund_reason_type": "1301", "create_time": "2022-09-01 10:05:28"}),
        ("order_refund_info", "insert", "100", None, {"id": "r2", "order_id": "2", "sku_id": "s", "refund_type": "1501", "refund_reason_type": "1301"}),
        ("order_info", "update", "105", {"order_status": "1002"}, {"id": "1", "order_status": "1005", "province_id": "7"}),
        ("order_info", "update", "106", {"order_status": "1002"}, {"id": "2", "order_status": "1005", "province_id": "8"}),
        ("refund_payment", "update", "200", {"refund_status": "0702"}, {"id": "p1", "order_id": "1", "sku_id": "s", "payment_type": "1101", "refund_status": "0701", "total_amount": "5", "callback_time": "2022-09-01 11:00:00"}),
        ("order_info", "update", "201", {"order_status": "1005"}, {"id": "1", "order_status": "1006", "province_id": "7", "user_id": "u"}),
        ("order_refund_info", "update", "202", {"refund_status": "0702"}, {"order_id": "1", "sku_id": "s", "refund_num": "3", "refund_status": "0705"}),
        ("order_refund_info", "update", "202", {"refund_status": "0702"}, {"order_id": "1", "sku_id": "other", "refund_num": "4", "refund_status": "0705"}),
    )
    dic = lookups.dictionary(spark)
    asked = dwd.order_refunds(log, dic)
    assert asked.columns == schemas.ORDER_REFUND
    assert rows_of(asked, "id", "province_id", "refund_type_name", "refund_reason_type_name") == [("r1", "7", "refund only", "quality")]
    paid = dwd.refund_payments(log, dic)
    assert paid.columns == schemas.REFUND_PAY_SUC
    assert rows_of(paid, "id", "user_id", "refund_num", "date_id") == [("p1", "u", "3", "2022-09-01")]


RECORDS = [
    (1, '{"common":{"mid":"m","is_new":"1"},"start":{"entry":"icon"},"err":{"code":"1"},"ts":1000}'),
    (2, '{"common":{"mid":"m","is_new":"1"},"page":{"page_id":"home"},"err":{"code":"2"},"displays":[],"ts":2000}'),
    (3, '{"common":{"mid":"m"},"page":{"page_id":"home"},"displays":[{"item":"1"},{"item":"2"}],"actions":null,"ts":3000}'),
    (4, '{"common":{"mid":"m"},"page":{"page_id":"home"},"actions":[{"item":"9"}],"ts":4000}'),
    (5, '{"common": broken'),
    (6, None),
    (7, '{"common":{"mid":"m","is_new":"1"},"page":{"page_id":"home"},"ts":"x'),
]


def test_log_split(spark, tmp_path):
    raw = spark.createDataFrame(RECORDS, "seq long, value string")
    good, dirty = topics.split_dirty(raw, schemas.TRAFFIC_LOG)
    assert rows_of(dirty, "seq") == [(5,), (7,)]
    outputs = dwd.log_split(topics.page_time(good))
    ids = {topic.split("_")[-2]: [r[0] for r in rows_of(df, "seq")] for topic, df in outputs.items()}
    assert ids == {"err": [1, 2], "start": [1], "page": [2, 3, 4], "display": [3, 3], "action": [4]}
    assert "err" not in outputs[routing.START_TOPIC].columns and "err" in outputs[routing.ERR_TOPIC].columns
    routed = dwd.log_messages(raw)
    counts = {r[0]: r[1] for r in routed.groupBy("topic").count().collect()}
    assert {t: df.count() for t, df in outputs.items()} | {routing.DIRTY_TOPIC: 2} == counts
    handed = dwd.log_messages(raw, f"{tmp_path}/parsed")
    assert rows_of(handed) == rows_of(routed)
    # what follows the hand-over parses nothing
    assert "from_json" not in handed._jdf.queryExecution().optimizedPlan().toString()


def test_configured_dimensions(spark, tmp_path):
    schema = "table string, type string, data map<string,string>, seq long"
    rows = spark.createDataFrame(
        [
            ("a", "insert", {"id": "1", "x": "v1", "secret": "s"}, 1),
            ("a", "update", {"id": "1", "x": "v2"}, 2),
            ("a", "update", {"id": "1", "y": "w"}, 3),
            ("a", "update", {"id": "1", "x": None}, 4),
            ("a", "delete", {"id": "2", "x": "gone"}, 5),
            ("a", "bootstrap-start", {"id": "3"}, 6),
            ("b", "insert", {"id": "1"}, 7),
            ("none", "insert", {"id": "1"}, 8),
        ],
        schema,
    )
    entry = lambda t, cols, pk=None, ext=None: (t, f"dim_{t}", cols, pk, ext)
    from pyspark.sql.types import LongType, StructField, StructType

    config_schema = StructType([StructField("seq", LongType()), *schemas.CONFIG_CHANGE.fields])
    config = spark.createDataFrame(
        [(1, "r", None, entry("a", "id,x")), (2, "u", None, entry("a", "id,x,y")), (3, "c", None, entry("b", "id", "id", "X")), (4, "d", entry("b", "id"), None)],
        config_schema,
    )
    in_force = lookups.latest_config(config)
    assert rows_of(in_force) == [("a", "dim_a", "id,x,y", "id", "")]
    assert rows_of(dim.dimension_table(rows, config, "dim_a", ["id", "x", "y"])) == [("1", None, "w"), ("2", "gone", None)]
    cells = dim.dimension_cells(rows, config)
    assert ("dim_a", "1", "y", "w") in rows_of(cells) and cells.where("column = 'secret'").count() == 0

    run = dim.upsert_batch(lambda s: config, str(tmp_path / "dims"), ddl=True)
    run(rows.where("seq <= 2"), 0)
    run(rows.where("seq > 2"), 1)
    run(rows.where("seq > 2"), 1)  # written again after a restart
    want = [("1", None, "w"), ("2", "gone", None)]
    store = dimensions.DimensionStore(str(tmp_path / "dims"))
    assert rows_of(store.read(spark, "dim_a", "id", ["id", "x", "y"])) == want
    assert [c.dataType.simpleString() for c in spark.table("dim_a").schema] == ["string"] * 3
    assert rows_of(spark.table("dim_a")) == want
    # a read merges what came after the snapshot, and nothing before it
    before = spark.table("dim_a").inputFiles()
    store.write(routing.route_changes(rows.where("seq = 3").withColumn("data", F.create_map(F.lit("id"), F.lit("1"), F.lit("x"), F.lit("new"))), in_force), 2)
    again = store.read(spark, "dim_a", "id", ["id", "x", "y"])
    assert rows_of(again) == [("1", "new", "w"), ("2", "gone", None)]
    assert "(batch_id" in again._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1]
    # the catalog has it after the next publication; a column that is configured later is added
    wide = in_force.withColumn("sink_columns", F.lit("id,x,y,secret"))
    store.publish(spark, wide.first())
    assert rows_of(spark.table("dim_a")) == [("1", "new", "w", None), ("2", "gone", None, None)]
    assert not set(before) & set(spark.table("dim_a").inputFiles())
    base = store.snapshot(spark, "dim_a", "id", ["id", "x", "y", "secret"])
    assert base == store.snapshot(spark, "dim_a", "id", ["id", "x", "y", "secret"])
    spark.range(1).write.saveAsTable("dim_own")
    with pytest.raises(ValueError):
        store.publish(spark, wide.withColumn("sink_table", F.lit("dim_own")).first())
    spark.sql("DROP TABLE dim_own")
    spark.sql("DROP TABLE dim_a")


def test_versioned_table(spark, tmp_path):
    columns = ["stt", "edt", "n", "ts"]
    table = tables.VersionedTable(str(tmp_path / "t"), ["stt", "edt"], columns)
    batch = lambda *rows: spark.createDataFrame(rows, "stt string, edt string, n long, ts long").withColumn("helper", F.lit(1))
    day = ("2024-01-01 00:00:00", "2024-01-01 00:00:10")
    other = ("2024-01-02 00:00:00", "2024-01-02 00:00:10")
    table.append(batch((*day, 1, 10), (*other, 9, 10)), 0)
    table.append(batch((*day, 2, 12)), 1)
    table.append(batch((*day, 3, 11)), 2)
    table.append(batch((*other, 8, 10)), 3)
    assert rows_of(table.read(spark), "stt", "n") == [(day[0], 2), (other[0], 8)]
    assert rows_of(table.read(spark, 20240101), "stt", "n") == [(day[0], 2)]
    plan = table.read(spark, 20240101)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert rows_of(table.compact(spark, str(tmp_path / "c")).read(spark), "stt", "n") == [(day[0], 2), (other[0], 8)]
    with pytest.raises(ValueError):
        tables.by_position(table.read(spark), ["a"])
    # a day is the outer folder, and a repeated micro-batch replaces its own rows
    table.append(batch((*day, 4, 11)), 2)
    assert sorted(x.name for x in (tmp_path / "t").glob("dt=*")) == ["dt=20240101", "dt=20240102"]
    assert rows_of(table.versions(spark).where("batch_id = 2"), "n") == [(4,)]


def test_summary_without_rows(spark, tmp_path):
    name = "dws_trade_province_order_window"
    table = tables.VersionedTable.summary(str(tmp_path / "s"), name)
    assert table.read(spark).collect() == [] and table.read(spark, 20240101).collect() == []  # not there yet
    rows = province_rows(spark, ("2024-01-01", "1", "p", 5.0, 1)).withColumn("order_amount", F.col("order_amount").cast("decimal(38,2)"))
    table.append(rows.limit(0))
    assert table.read(spark).collect() == []
    table.append(rows, 1)
    assert [r.order_amount for r in table.read(spark, 20240101).collect()] == [5]


def test_equal_versions(spark, tmp_path):
    """The later micro-batch counts; in a plain table, whose arrival nobody knows, always the same row."""
    name = "dws_trade_province_order_window"
    table = tables.VersionedTable.summary(str(tmp_path / "s"), name)
    for number, amount in enumerate([9, 1, 5]):
        rows = province_rows(spark, ("2024-01-01", "1", "p", float(amount), 7))
        table.append(rows.withColumn("order_amount", F.col("order_amount").cast("decimal(38,2)")), number)
    assert [r.order_amount for r in table.read(spark).collect()] == [5]
    plain = table.versions(spark).drop("batch_id", "run")
    for n in (1, 3):
        assert [r.order_amount for r in tables.latest(plain.repartition(n), table.keys).collect()] == [9]


def test_two_queries_write_one_table(spark, tmp_path):
    """Their micro-batches have the same numbers, and neither replaces the other's."""
    spark.range(3).selectExpr("id AS a").write.parquet(str(tmp_path / "in"))
    for sink in (tables.FactTable(str(tmp_path / "facts")), tables.VersionedTable(str(tmp_path / "sums"), ["a"], ["a", "stt", "ts"])):
        for n in (1, 2):
            rows = spark.readStream.schema("a long").parquet(str(tmp_path / "in"))
            rows = rows.selectExpr(f"a + {n * 10} AS a", "'2024-01-01 00:00:00' AS stt", "1L AS ts")
            for _ in range(2):  # a restart adds nothing
                run_once(rows, sink.append, str(tmp_path / f"c-{type(sink).__name__}-{n}"))
        assert rows_of(sink.read(spark), "a") == [(10 * n + k,) for n in (1, 2) for k in range(3)]


def test_shared_folder_is_asked_for(monkeypatch):
    from types import SimpleNamespace

    from millrace.session import checkpoint_root

    unset = SimpleNamespace(get=lambda *_: None)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            checkpoint_root(SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master=master)))


def test_dimension_misses(spark):
    dims = {
        "dim_sku_info": spark.createDataFrame([("1", "n", "t", "c3", "p"), ("2", "m", "gone", None, None)], "id string, sku_name string, tm_id string, category3_id string, spu_id string"),
        "dim_base_trademark": spark.createDataFrame([("t", "T")], "id string, tm_name string"),
        "dim_spu_info": spark.createDataFrame([("p", "P")], "id string, spu_name string"),
        "dim_base_category3": spark.createDataFrame([("c3", "C3", "c2")], "id string, name string, category2_id string"),
        "dim_base_category2": spark.createDataFrame([("c2", "C2", "c1")], "id string, name string, category1_id string"),
        "dim_base_category1": spark.createDataFrame([("c1", "C1")], "id string, name string"),
    }
    flat = enrich.flatten_sku(dims)
    facts = spark.createDataFrame([("1",), ("2",), ("3",)], "sku string")
    got = enrich.enrich(facts, flat, "sku", {"trademark_name": "tm", "category1_name": "c1"}, dim_key="sku_id")
    assert rows_of(got) == [("1", "T", "C1"), ("2", None, None), ("3", None, None)]


def province_rows(spark, *rows):
    return spark.createDataFrame([(f"{d} 00:00:00", f"{d} 00:00:10", p, n, 1, a, v) for d, p, n, a, v in rows], "stt string, edt string, province_id string, province_name string, order_count long, order_amount double, ts long")


def test_serving(spark):
    rows = province_rows(spark, ("2024-01-01", "1", "A", 5.0, 1), ("2024-01-01", "1", "A", 7.0, 2), ("2024-01-01", "2", "B", 1.5, 1), ("2024-01-02", "1", "A", 9.0, 1))
    assert rows_of(ads.gmv(rows, 20240101)) == [(__import__("decimal").Decimal("8.50"),)]
    assert rows_of(ads.gmv(rows, 20230101)) == [(None,)]
    assert ads.gmv_payload(rows, 20230101).first()[0] == '{"status":0,"data":null}'
    assert ads.gmv(rows).first()[0] is None and ads.gmv(rows, 0).first()[0] is None
    payload = ads.province_payload(rows, 20240101).first()[0]
    assert payload == '{"status":0,"data":{"mapData":[{"name":"A","value":7.00},{"name":"B","value":1.50}],"valueName":"交易额"}}'
    views = [("x", 3), ("y", 3), ("z", 0), ("w", 9)]
    view_rows = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 00:00:10", "v", c, "a", "1", n, 1) for c, n in views], "stt string, edt string, vc string, ch string, ar string, is_new string, uv_ct long, ts long")
    top = ads.top_channels(view_rows, 20240101, 2)
    assert [tuple(r) for r in top.collect()] == [("w", 9), ("x", 3)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert ads.top_channels(view_rows, 20240101).count() == 3
    assert ads.channel_payload(view_rows, 20240101, 2).first()[0] == '{"status":0,"data":[{"name":"w","value":9},{"name":"x","value":3}]}'


def test_windows_start_at_the_epoch(spark):
    rows = visits(spark, (1, "a", "2024-01-01 00:00:09.999", ""), (2, "a", "2024-01-01 00:00:10", ""))
    got = tumble(rows, [F.count(F.lit(1)).alias("n")], now=F.lit(1))
    assert rows_of(got, "stt", "edt", "n") == [("2024-01-01 00:00:00", "2024-01-01 00:00:10", 1), ("2024-01-01 00:00:10", "2024-01-01 00:00:20", 1)]


def test_day_follows_the_session_zone(spark):
    rows = visits(spark, (1, "a", "2024-01-01 00:00:00", ""))
    utc = rows.select(times.day(F.timestamp_millis(F.lit(1704038400000)))).first()[0]
    try:
        spark.conf.set("spark.sql.session.timeZone", "+08:00")
        east = rows.select(times.day(F.timestamp_millis(F.lit(1704038400000)))).first()[0]
        gap = rows.select(times.days_since(F.timestamp_millis(F.lit(1704038400000)), F.lit("2023-12-24"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (utc, east, gap) == ("2023-12-31", "2024-01-01", 8)


def test_logins_and_searches(spark):
    row = lambda i, uid, last, kind="keyword", item="x": (i, (uid,), (last, kind, item))
    rows = spark.createDataFrame(
        [row(1, "u", "login"), row(2, "u", ""), row(3, "u", None), row(4, "u", "home"), row(5, "", "login"), row(6, None, None), row(7, "u", "search"), row(8, "u", "search", "sku"), row(9, "u", "search", "keyword", None)],
        "seq long, common struct<uid:string>, page struct<last_page_id:string,item_type:string,item:string>",
    )
    assert rows_of(rows.where(changes.is_login()), "seq") == [(1,), (2,), (3,)]
    assert rows_of(rows.where(changes.is_keyword_search()), "seq") == [(7,)]


def test_words(spark):
    rows = spark.createDataFrame([("Red  口红, no.5",), ("",), (None,)], "t string")
    assert [r[0] for r in rows.select(text.words("t")).collect()] == [["red", "口红", "no", "5"], [], None]


def test_segmented_by_a_dictionary_of_any_size(spark):
    dictionary = spark.createDataFrame([("口红",), ("口",), ("手机",), ("白色手机",), ("AB",), ("ab",), (None,), ("",)], "word string")
    rows = spark.createDataFrame([(1, "白色手机口红新"), (2, "xab, abab"), (3, ""), (4, None), (5, "xab, abab"), (6, "q")], "i int, t string")
    want = {1: ["白色手机", "口红", "新"], 2: ["x", "ab", "ab", "ab"], 3: [], 4: None, 5: ["x", "ab", "ab", "ab"], 6: ["q"]}
    assert {r.i: r["words"] for r in text.segmented(rows, F.col("t"), dictionary).collect()} == want
    many = spark.range(500_001).select(F.concat(F.lit("w"), "id").alias("word"))
    cut = text.segmented(spark.createDataFrame([("w500000w17x",)], "t string"), F.col("t"), many)
    assert cut.first()["words"] == ["w500000", "w17", "x"] and text.segmented(rows, F.col("t"), dictionary.limit(0)).count() == 6


def test_bounded_join_needs_both_key_and_time(spark):
    left = spark.createDataFrame([("a", 100), ("a", 300), ("b", 100)], "k string, s long").select("k", F.timestamp_seconds("s").alias("event_time"))
    right = spark.createDataFrame([("a", 105, "x"), ("a", 94, "y")], "r string, s long, v string").select("r", "v", F.timestamp_seconds("s").alias("event_time"))
    got = joins.bounded_join(left, right, {"k": "r"}, 5, "left_outer")
    assert rows_of(got, "k", F.unix_seconds("event_time"), "v") == [("a", 100, "x"), ("a", 300, None), ("b", 100, None)]


def test_connector_options():
    reader = topics.kafka_options(["a", "b"], "host:9092", "group", "latest")
    assert reader["subscribe"] == "a,b" and reader["startingOffsets"] == "latest" and reader["kafka.group.id"] == "group"
    writer = external.kafka_sink_options("host:9092")
    assert writer == {"kafka.bootstrap.servers": "host:9092"}
    sink = external.jdbc_sink_options("jdbc:x", "t", "d")
    assert sink["batchsize"] == "1000"
    assert lookups.jdbc_options("jdbc:x", "base_dic", "u", "p")["dbtable"] == "base_dic"


def test_reference_table_is_read_per_batch(spark):
    versions = iter([[("1", "old")], [("1", "new")]])
    load = lambda s: s.createDataFrame(next(versions), "id string, name string")
    seen = []
    run = lookups.per_batch(load, lambda batch, ref, i: seen.extend(enrich.enrich(batch, ref, "k", {"name": "name"}).collect()))
    batch = spark.createDataFrame([("1",)], "k string")
    run(batch, 0)
    run(batch, 1)
    assert [r["name"] for r in seen] == ["old", "new"]


def test_join_without_bound(spark):
    """A partner that comes after eight days is found where no wait is set."""
    from millrace.operators.joins import bounded_join

    left = spark.sql("SELECT 'o' AS order_id, TIMESTAMP '2024-01-01 00:00:00' AS event_time")
    right = spark.sql("SELECT 'o' AS id, 'paid' AS state, TIMESTAMP '2024-01-09 00:00:00' AS event_time")
    assert rows_of(bounded_join(left, right, {"order_id": "id"}, None), "order_id", "state") == [("o", "paid")]
    assert rows_of(bounded_join(left, right, {"order_id": "id"}, 905)) == []


def test_accumulators_merge(spark, monkeypatch):
    """A state that no built-in has: the longest text, ties to the smaller one, and how often it came; one key has most rows."""
    from millrace.operators.accumulators import accumulate

    def better(a, b):
        if a[0] == b[0]:
            return (a[0], a[1] + b[1])
        return a if a[0] is not None and (b[0] is None or (-len(a[0]), a[0]) < (-len(b[0]), b[0])) else b

    def add(state, rows):
        for v in rows["v"]:
            state = better(state, (v, 1)) if v is not None else state
        return state

    values = [("hot", f"{'x' * (i % 7)}{i % 3}") for i in range(900)] + [(None, "a"), (None, "b"), ("none", None), (None, "a")]
    rows = spark.createDataFrame(values, "k string, v string").repartition(7)
    got = accumulate(rows, ["k"], lambda: (None, 0), add, better, lambda s: {"best": s[0], "n": s[1]}, "best string, n long", "best string, n long")
    top = [v for k, v in values if k == "hot" and len(v) == 7]
    assert rows_of(got) == sorted([("hot", min(top), top.count(min(top))), (None, "a", 2), ("none", None, 0)], key=repr)
    assert accumulate(rows.limit(0), ["k"], lambda: (None, 0), add, better, lambda s: {"best": s[0], "n": s[1]}, "best string, n long", "best string, n long").collect() == []


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_rows_behind_the_watermark(spark, parts):
    from millrace.operators.windows import behind_watermark

    seconds = [10, 12, 5, 30, 26, 27, None, 40, 36, 37, 100, 96, 97, 1, 100]
    rows = spark.createDataFrame(list(enumerate(seconds)), "n long, s long").select("n", F.timestamp_seconds("s").alias("t")).repartition(4)
    want, top = [], None
    for n, s in enumerate(seconds):
        want.append((n, s is not None and top is not None and s < top - 3))
        top = s if top is None else max(top, s) if s is not None else top
    assert sorted((r.n, r.late) for r in behind_watermark(rows, "t", ["n"], 3, "n", parts).collect()) == want

"""Warehouse inputs derived from the star-schema test tables (see FIXTURES.md §2).

Every branch of the change log names its table, type and codes by literals and its values by a map of
columns, so that Catalyst prunes the branches and columns a job does not ask for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.values import once
from millrace.sources.lookups import literal_table


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table as a batch or, for the tables a ``StreamFolder`` names, as a stream."""
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    if name in getattr(folder, "streams", ()):
        # a stream reads a folder or a pattern, not a single file
        return spark.readStream.schema(table.schema).parquet(f"{folder}/{name}*.parquet")
    return table


class StreamFolder(str):
    """Folder whose tables named in ``streams`` are read as streams."""

    streams: frozenset[str] = frozenset()

    @classmethod
    def of(cls, folder: str, *streams: str) -> StreamFolder:
        made = cls(folder)
        made.streams = frozenset(streams)
        return made


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table with its zone-less timestamps read as instants of the session zone."""
    df = source(spark, folder, name)
    return df.selectExpr(*[f"CAST({c} AS TIMESTAMP) AS {c}" if t == "timestamp_ntz" else c for c, t in df.dtypes])


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


# --- click log ---------------------------------------------------------------------------------------


def page_views(spark: SparkSession, folder: str, items: bool = False) -> DataFrame:
    """Flat click log. ``items`` also looks the searched item up, which costs a join."""
    views = table(spark, folder, "events").selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
    views = views.selectExpr(
        "event_id AS seq",
        "ts",
        "unix_millis(ts) AS ts_ms",
        "k",
        "event_type",
        "CAST(user_id AS STRING) AS mid",
        "CASE WHEN k % 5 != 0 THEN CAST(user_id AS STRING) END AS uid",
        "concat('v', user_id % 4) AS vc",
        "concat('ch', user_id % 5) AS ch",
        "concat('ar', user_id % 7) AS ar",
        "CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS is_new",
        "CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_list' WHEN 'purchase' THEN 'good_detail' "
        "WHEN 'signup' THEN 'login' WHEN 'error' THEN 'error' END AS page_id",
        "CASE event_type WHEN 'view' THEN '' WHEN 'signup' THEN '' WHEN 'click' THEN 'search' WHEN 'purchase' THEN 'login' END "
        "AS last_page_id",
        "'keyword' AS item_type",
        "CAST(round(value * 1000) AS BIGINT) AS during_time",
    )
    if not items:
        return views.withColumn("item", F.lit(None).cast("string"))
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("item"))
    return views.join(part, "k", "left")


def page_log(spark: SparkSession, folder: str, items: bool = False) -> DataFrame:
    """Page topic: every event as a page view, nested as in the topic."""
    return page_views(spark, folder, items).select(
        "seq",
        F.col("ts").alias("rowtime"),
        F.struct("mid", "uid", "vc", "ch", "ar", "is_new").alias("common"),
        F.struct("page_id", "last_page_id", "item", "item_type", "during_time").alias("page"),
        F.col("ts_ms").alias("ts"),
    )


def traffic_log(spark: SparkSession, folder: str, items: bool = False) -> DataFrame:
    """Nested click log with the schema of the topic, plus ``seq`` and ``rowtime``."""
    v = page_views(spark, folder, items)
    entry = lambda kind: lambda i: F.create_map(
        F.lit("item"), F.concat(F.lit(kind), _text(i)), F.lit("order"), _text(i)
    )
    count = lambda n: F.filter(F.sequence(F.lit(1), F.lit(n)), lambda i: i <= F.col("k") % (n + 1))
    is_start = F.col("k") % 10 == 0
    return v.select(
        "seq",
        F.col("ts").alias("rowtime"),
        F.struct("mid", "uid", "vc", "ch", "ar", "is_new").alias("common"),
        F.when(~is_start, F.struct("page_id", "last_page_id", "item", "item_type", "during_time")).alias("page"),
        F.when(is_start, F.create_map(F.lit("entry"), F.lit("icon"))).alias("start"),
        F.when(F.col("event_type") == "error", F.create_map(F.lit("code"), _text("k"))).alias("err"),
        F.transform(count(3), entry("d")).alias("displays"),
        F.when(F.col("k") % 3 != 0, F.transform(count(2), entry("a"))).alias("actions"),
        F.col("ts_ms").alias("ts"),
    )


def traffic_topic(spark: SparkSession, folder: str, items: bool = False) -> DataFrame:
    """Raw topic text of the click log, with some broken and some empty records."""
    log = traffic_log(spark, folder, items)
    text = F.to_json(F.struct(*[f.name for f in schemas.TRAFFIC_LOG.fields]))
    value = (
        F.when(F.col("seq") % 50 == 7, F.concat(F.lit('{"common": broken '), _text("seq")))
        .when(F.col("seq") % 50 == 11, F.lit(None))
        .otherwise(text)
    )
    return once(log.withColumn("_text", value), ["seq"], value=F.col("_text"))


# --- change log --------------------------------------------------------------------------------------


def _map(**values: str) -> Column:
    """Map of text values from SQL expressions, written as one expression to keep query building quick."""
    return F.expr("map(" + ", ".join(f"'{name}', CAST({value} AS STRING)" for name, value in values.items()) + ")")


def _code(code: str) -> str:
    return f"'{code}'"


def _change(df: DataFrame, name: str, kind: Column | str, ts: Column, data: Column, old: Column | None = None) -> DataFrame:
    """One branch of the change log; ``event_time`` is the time of the change, ``ts`` the same in seconds as text."""
    return df.select(
        F.lit("shop").alias("database"),
        F.lit(name).alias("table"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("type"),
        _text(ts).alias("ts"),
        (old if old is not None else F.lit(None).cast("map<string,string>")).alias("old"),
        data.alias("data"),
        F.timestamp_seconds(ts).alias("event_time"),
    )


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").withColumn("t0", F.unix_seconds("o_orderdate"))


def _lines(spark: SparkSession, folder: str, as_text: bool = False) -> DataFrame:
    """Order lines with their order's date and user. Tables are joined by the order's key ``as_text`` if asked, then ``order_id``."""
    line = table(spark, folder, "lineitem").drop("l_shipdate", "l_linestatus")
    order = _orders(spark, folder).select("o_orderkey", "o_custkey", "o_orderdate", "t0")
    if not as_text or line.isStreaming:
        return line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("order_id", _text("l_orderkey"))
    line, order = line.withColumn("order_id", _text("l_orderkey")), order.withColumn("_order", _text("o_orderkey"))
    return line.join(order, F.col("order_id") == F.col("_order")).drop("_order")


_LINE_ID = "l_orderkey * 10 + l_linenumber"
_PRICE = "CAST(l_extendedprice AS DECIMAL(16,2))"


def _share(rate: str) -> str:
    return f"CAST({_PRICE} * CAST({rate} AS DECIMAL(4,2)) AS DECIMAL(16,2))"


def _later(seconds: int) -> str:
    return f"date_format(timestamp_seconds(t0 + {seconds}), 'yyyy-MM-dd HH:mm:ss')"


def cart_info(spark: SparkSession, folder: str) -> DataFrame:
    v = page_views(spark, folder)
    kind = F.expr("CASE event_type WHEN 'view' THEN 'insert' WHEN 'signup' THEN 'delete' ELSE 'update' END")
    old = F.expr(
        "CASE event_type WHEN 'click' THEN map('sku_num', CAST(seq % 9 AS STRING)) "
        "WHEN 'purchase' THEN map('source_type', '2401') WHEN 'error' THEN map('sku_num', 'n/a') END"
    )
    source = "concat('240', CAST(mid AS BIGINT) % 4 + 1)"
    data = _map(id="seq", user_id="mid", sku_id="k", source_type=source, sku_num="k % 7 + 1")
    return _change(v, "cart_info", kind, F.unix_seconds("ts"), data, old)


def order_info(spark: SparkSession, folder: str) -> DataFrame:
    o = _orders(spark, folder)

    def branch(kind: str, delay: int, status: str, keep: str | None, old: Column | None) -> DataFrame:
        rows = o if keep is None else o.where(keep)
        data = _map(
            id="o_orderkey",
            user_id="o_custkey",
            province_id="o_custkey % 25",
            operate_time=_later(delay),
            order_status=_code(status),
        )
        return _change(rows, "order_info", kind, F.expr(f"t0 + {delay}"), data, old)

    was = lambda code: _map(order_status=_code(code))
    branches = [
        branch("insert", 0, "1001", None, None),
        branch("update", 60, "1003", "o_orderstatus = 'P'", was("1001")),
        branch("update", 60, "1002", "o_orderstatus = 'F'", was("1001")),
        branch("update", 120, "1005", "o_orderkey % 5 = 0", was("1002")),
        branch("update", 180, "1006", "o_orderkey % 10 = 0", was("1005")),
        branch("update", 240, "1003", "o_orderkey % 7 = 0", _map(operate_time=_later(0))),
    ]
    return reduce(DataFrame.unionByName, branches)


def order_detail(spark: SparkSession, folder: str) -> DataFrame:
    values = dict(
        id=_LINE_ID,
        sku_id="l_partkey",
        sku_name="concat('sku-', l_partkey)",
        create_time=_later(0),
        source_id="l_suppkey",
        source_type="concat('240', l_suppkey % 4 + 1)",
        sku_num="CAST(l_quantity AS INT)",
        order_price=_PRICE,
        split_total_amount=_PRICE,
        split_activity_amount=f"CASE WHEN l_linenumber % 3 != 0 THEN {_share('l_discount')} END",
        split_coupon_amount=f"CASE WHEN l_linenumber % 2 != 0 THEN {_share('l_tax')} END",
    )
    lines = _lines(spark, folder, as_text=True)
    made = {"_ts": F.expr("t0 + (l_linenumber - 1) * 200"), **{name: _text(F.expr(value)) for name, value in values.items()}}
    # the order is kept beside a table's other values, so that Spark sees that the rows lie by order already; a stream's state is dealt out anew
    rows = lines.select("order_id", *[value.alias(name) for name, value in made.items()]) if lines.isStreaming else once(lines, ["order_id"], **made)
    data = _map(id="id", order_id="order_id", **{name: name for name in values if name != "id"})
    return _change(rows, "order_detail", "insert", F.col("_ts"), data)


def _order_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Each order with its seven possible line numbers."""
    o = _orders(spark, folder).selectExpr("*", "explode(sequence(1, 7)) AS ln")
    return o.selectExpr("*", "o_orderkey * 10 + ln AS line_id")


def order_detail_activity(spark: SparkSession, folder: str) -> DataFrame:
    rows = _order_positions(spark, folder).where("ln % 3 != 0")
    data = _map(order_detail_id="line_id", activity_id="o_orderkey % 10", activity_rule_id="ln")
    return _change(rows, "order_detail_activity", "insert", F.expr("t0 + ln * 5"), data)


def order_detail_coupon(spark: SparkSession, folder: str) -> DataFrame:
    rows = _order_positions(spark, folder).where("ln % 2 = 1")
    data = _map(order_detail_id="line_id", coupon_id="o_orderkey % 4")
    ts = F.expr("t0 + CASE WHEN o_orderkey % 6 = 0 THEN 2000 ELSE 5 END")
    return _change(rows, "order_detail_coupon", "insert", ts, data)


def payment_info(spark: SparkSession, folder: str) -> DataFrame:
    data = _map(
        user_id="o_custkey",
        order_id="o_orderkey",
        payment_type="concat('110', o_orderkey % 4 + 1)",
        callback_time=_later(90),
        payment_status="CASE WHEN o_orderstatus != 'O' THEN '1602' ELSE '1601' END",
    )
    kind = F.expr("CASE WHEN o_orderkey % 8 = 0 THEN 'insert' ELSE 'update' END")
    return _change(_orders(spark, folder), "payment_info", kind, F.expr("t0 + 90"), data)


def order_refund_info(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder).where("l_returnflag = 'R'")

    def data(status: str) -> Column:
        return _map(
            id=_LINE_ID,
            user_id="o_custkey",
            order_id="l_orderkey",
            sku_id="l_partkey",
            refund_type="concat('150', l_suppkey % 3 + 1)",
            refund_num="CAST(l_quantity AS INT)",
            refund_amount=_PRICE,
            refund_reason_type="concat('130', l_partkey % 8 + 1)",
            refund_reason_txt="concat('line ', l_linenumber)",
            create_time=_later(120),
            refund_status=_code(status),
        )

    old = F.expr("CASE WHEN l_linenumber <= 5 THEN map('refund_status', '0702') ELSE map('refund_num', '0') END")
    made = _change(lines, "order_refund_info", "insert", F.expr("t0 + 116 + l_linenumber * 2"), data("0701"))
    paid = _change(lines, "order_refund_info", "update", F.expr("t0 + 200"), data("0705"), old)
    return made.unionByName(paid)


def refund_payment(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder).where("l_returnflag = 'R'")
    data = _map(
        id=_LINE_ID,
        order_id="l_orderkey",
        sku_id="l_partkey",
        payment_type="concat('110', l_suppkey % 4 + 1)",
        callback_time=_later(210),
        total_amount=_PRICE,
        refund_status="CASE WHEN l_linenumber % 4 != 0 THEN '0701' ELSE '0702' END",
    )
    return _change(lines, "refund_payment", "update", F.expr("t0 + 210"), data, _map(refund_status=_code("0703")))


def change_log(spark: SparkSession, folder: str, *tables: str) -> DataFrame:
    """The change topic, decoded: all its tables, or only the named ones."""
    parts = [
        cart_info,
        order_info,
        order_detail,
        order_detail_activity,
        order_detail_coupon,
        payment_info,
        order_refund_info,
        refund_payment,
    ]
    return reduce(DataFrame.unionByName, [p(spark, folder) for p in parts if not tables or p.__name__ in tables])


def change_topic(changes: DataFrame) -> DataFrame:
    """Change rows as raw topic text."""
    return changes.select(F.to_json(F.struct("database", "table", "type", "ts", "old", "data")).alias("value"))




# --- dimensions --------------------------------------------------------------------------------------

# Configuration changes of the dimension job used in tests and registered queries.
CONFIG_CHANGES = [
    (1, "r", None, ("sku_info", "dim_sku_info", "id,sku_name,tm_id,category3_id,spu_id", "id", None)),
    (2, "r", None, ("base_province", "dim_base_province", "id,name", None, None)),
    (3, "c", None, ("base_trademark", "dim_base_trademark", "id,tm_name", "id", "SALT_BUCKETS = 3")),
    (4, "u", None, ("base_province", "dim_base_province", "id,name,region_id,area_code", None, None)),
    (5, "c", None, ("user_info", "dim_user_info", "id,name", "id", None)),
    (6, "d", ("user_info", "dim_user_info", "id,name", "id", None), None),
]


def config_changes(spark: SparkSession) -> DataFrame:
    """The changes above as a literal relation, with the size known to the planner."""
    fields = ["source_table", "sink_table", "sink_columns", "sink_pk", "sink_extended"]
    flat = [(seq, op, *(before or (None,) * 5), *(after or (None,) * 5)) for seq, op, before, after in CONFIG_CHANGES]
    names = ["seq", "op", *[f"b_{f}" for f in fields], *[f"a_{f}" for f in fields]]
    rows = literal_table(spark, flat, ", ".join(names))
    image = lambda p: F.struct(*[F.col(f"{p}_{f}").cast("string").alias(f) for f in fields])
    before, after = F.when(F.col("b_source_table").isNotNull(), image("b")), F.when(F.col("a_source_table").isNotNull(), image("a"))
    return rows.select(F.col("seq").cast("long").alias("seq"), "op", before.alias("before"), after.alias("after"))


def dimension_log(spark: SparkSession, folder: str) -> DataFrame:
    """Change rows of the dimension tables, numbered by ``seq`` within a key."""

    def rows(df: DataFrame, name: str, kind: Column | str, seq: int, data: Column) -> DataFrame:
        return df.select(
            F.lit(name).alias("table"),
            (F.lit(kind) if isinstance(kind, str) else kind).alias("type"),
            data.alias("data"),
            F.lit(seq).cast("long").alias("seq"),
        )

    part = table(spark, folder, "part")
    nation = table(spark, folder, "nation")
    customer = table(spark, folder, "customer")
    region = table(spark, folder, "region")
    brand = part.groupBy("p_brand").agg(F.min("p_partkey").alias("first"))
    sku = _map(
        id="p_partkey", sku_name="p_name", tm_id="p_brand", category3_id="p_type", spu_id="p_size",
        price="CAST(p_retailprice AS DECIMAL(16,2))",
    )
    province = _map(id="n_nationkey", name="n_name", region_id="n_regionkey", iso_code="n_name")
    every = lambda n, left=0: part.where(f"p_partkey % {n} = {left}")
    none = F.lit(None).cast("map<string,string>")
    return reduce(
        DataFrame.unionByName,
        [
            rows(part, "sku_info", "bootstrap-insert", 1, sku),
            rows(every(100, 1), "sku_info", "bootstrap-start", 2, sku),
            rows(every(3), "sku_info", "update", 3, _map(id="p_partkey", sku_name="upper(p_name)", price="1")),
            rows(every(9), "sku_info", "update", 4, _map(id="p_partkey", tm_id="'Brand#0'")),
            rows(every(27), "sku_info", "delete", 5, _map(id="p_partkey", spu_id="0")),
            rows(every(11), "sku_info", "insert", 6, none),
            rows(nation, "base_province", "insert", 1, province),
            rows(brand, "base_trademark", "insert", 1, _map(id="p_brand", tm_name="upper(p_brand)")),
            rows(customer, "user_info", "insert", 1, _map(id="c_custkey", name="c_name")),
            rows(region, "base_region", "insert", 1, _map(id="r_regionkey", name="r_name")),
        ],
    )


def provinces(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as provinces; one is left out so that a miss occurs."""
    n = table(spark, folder, "nation").where(F.col("n_nationkey") != 7)
    return n.select(_text("n_nationkey").alias("id"), F.col("n_name").alias("name"), _text("n_regionkey").alias("region_id"))


def sku_dims(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Product dimensions out of ``part``; one brand has no entry of its own."""
    part = table(spark, folder, "part")
    head = F.substring("p_type", 1, 1)
    half = F.when(head < "M", "1").otherwise("2")
    return {
        "dim_sku_info": part.select(
            _text("p_partkey").alias("id"),
            F.col("p_name").alias("sku_name"),
            F.col("p_brand").alias("tm_id"),
            F.col("p_type").alias("category3_id"),
            _text("p_size").alias("spu_id"),
        ),
        "dim_base_trademark": part.where(F.col("p_brand") != "Brand#13")
        .select(F.col("p_brand").alias("id"), F.upper("p_brand").alias("tm_name"))
        .distinct(),
        "dim_spu_info": part.select(_text("p_size").alias("id"), F.concat(F.lit("spu-"), "p_size").alias("spu_name")).distinct(),
        "dim_base_category3": part.select(
            F.col("p_type").alias("id"), F.lower("p_type").alias("name"), head.alias("category2_id")
        ).distinct(),
        "dim_base_category2": part.select(
            head.alias("id"), F.concat(F.lit("c2-"), head).alias("name"), half.alias("category1_id")
        ).distinct(),
        "dim_base_category1": part.select(half.alias("id"), F.concat(F.lit("c1-"), half).alias("name")).distinct(),
    }


# --- facts -------------------------------------------------------------------------------------------


def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Order detail fact with its versions: the same ``id`` occurs more than once."""
    line = table(spark, folder, "lineitem")
    order = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    # the customer joins the few orders, so that the lines are shuffled once
    order = order.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    rows = line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.selectExpr(
        f"CAST({_LINE_ID} AS STRING) AS id",
        "CAST(l_orderkey AS STRING) AS order_id",
        "CAST(o_custkey AS STRING) AS user_id",
        "CAST(l_partkey AS STRING) AS sku_id",
        "CAST(c_nationkey AS STRING) AS province_id",
        "unix_seconds(o_orderdate) AS ts",
        "l_shipdate AS row_op_ts",
        f"{_PRICE} AS split_original_amount",
        f"CASE WHEN l_linenumber % 3 != 0 THEN {_share('l_discount')} END AS split_activity_amount",
        f"CASE WHEN l_linenumber % 2 != 0 THEN {_share('l_tax')} END AS split_coupon_amount",
        "struct(l_partkey, l_suppkey, l_extendedprice) AS seq",
    )
    total = "split_original_amount - coalesce(split_activity_amount, 0) - coalesce(split_coupon_amount, 0)"
    return rows.selectExpr("*", f"CAST({total} AS DECIMAL(16,2)) AS split_total_amount")

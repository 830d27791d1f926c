"""Detail-fact jobs. Each takes tables or streams and returns the fact; nothing here reads or writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import times
from millrace.functions.cdc import added, before, field, fields, grew, routed, transitioned
from millrace.functions.values import money
from millrace.operators.bounce import WITHIN_SECONDS, verdicts
from millrace.operators.changes import entry_page
from millrace.operators.enrich import lookup
from millrace.operators.joins import ORDER_WAIT, REFUND_WAIT, beside, bounded_join
from millrace.operators.routing import DIRTY_TOPIC, route_log, split_log
from millrace.operators.visitors import first_per_day, repair_new_visitor
from millrace.sources.topics import page_time, parsed, unreadable

# States of orders, payments and refunds.
ORDER_CANCELLED = "1003"
ORDER_REFUNDING = "1005"
ORDER_REFUNDED = "1006"
PAYMENT_DONE = "1602"
REFUND_PAYMENT_DONE = "0701"
REFUND_INFO_PAID = "0705"

#: Records a file of a parsed log, so that one large input file is dealt out to several tasks.
HAND_OVER_RECORDS = 500_000


# --- click log ---------------------------------------------------------------------------------------


def repaired_log(log: DataFrame) -> DataFrame:
    """Click log (with ``rowtime`` and ``seq``) whose new-visitor flags are corrected."""
    fixed = repair_new_visitor(log, "common.mid", "common.is_new", out="_fixed")
    return fixed.withColumn("common", F.col("common").withField("is_new", F.col("_fixed"))).drop("_fixed")


def log_messages(raw: DataFrame, hand_over: str | None = None) -> DataFrame:
    """Raw log text to messages ``seq, topic, value`` for all six topics, unreadable text included.

    ``hand_over`` names a new folder in shared storage to which a table's parsed log is written first, so that the text is read
    and parsed once; what comes after reads columns. Unreadable text doesn't reach the repair at all.
    """
    names = [f.name for f in schemas.TRAFFIC_LOG.fields]
    log = parsed(raw, schemas.TRAFFIC_LOG)
    # what was read of a broken record before the break must not count as a visit
    read = [F.when(~unreadable(), F.col("_doc")[n]).alias(n) for n in names]
    log = page_time(log.select("seq", F.when(unreadable(), F.col("value")).alias("_dirty"), *read))
    if log.isStreaming:
        return route_log(repaired_log(log), keep=["seq"], dirty=F.col("_dirty"))
    if hand_over:
        log.write.option("maxRecordsPerFile", HAND_OVER_RECORDS).parquet(hand_over)
        log = log.sparkSession.read.schema(log.schema).parquet(hand_over)
    good, dirty = repaired_log(log.where("_dirty IS NULL")), log.where("_dirty IS NOT NULL")
    return route_log(good, keep=["seq"], dirty=F.col("_dirty")).unionByName(dirty.select("seq", F.lit(DIRTY_TOPIC).alias("topic"), F.col("_dirty").alias("value")))


def log_split(log: DataFrame) -> dict[str, DataFrame]:
    """The typed outputs by topic. Persist ``log`` first where several of them are written."""
    return split_log(repaired_log(log))


def unique_visitors(pages: DataFrame, clock: str = "EventTime") -> DataFrame:
    """First entry page of every visitor and day. For ``clock`` see ``visitors.first_per_day``."""
    entries = pages.where(F.col("page").isNotNull() & entry_page())
    return first_per_day(entries.withColumn("_mid", F.col("common.mid")), "_mid", clock=clock).drop("_mid")


def judged_entries(pages: DataFrame, within_seconds: int = WITHIN_SECONDS) -> DataFrame:
    """Entry pages after which the visitor left, with their ``kind``: ``match`` or ``timeout``."""
    rows = pages.where(F.col("page").isNotNull()).withColumn("_mid", F.col("common.mid"))
    return verdicts(rows, "_mid", entry_page(), within_seconds=within_seconds).drop("_mid")


def user_jumps(pages: DataFrame, within_seconds: int = WITHIN_SECONDS) -> DataFrame:
    """Entry pages after which the visitor left."""
    return judged_entries(pages, within_seconds).drop("kind")


# --- trade -------------------------------------------------------------------------------------------


def cart_adds(changes: DataFrame, dic: DataFrame) -> DataFrame:
    """Products put into the cart: new entries and raised amounts."""
    kept = (F.col("type") == "insert") | grew("sku_num")
    rows = changes.where(routed("cart_info") & kept).select(
        *fields("id", "user_id", "sku_id"), added("sku_num").alias("sku_num"), field("source_type").alias("source_type_code"), "ts"
    )
    return lookup(rows, dic, "source_type_code", "source_type_name").select(*schemas.CART_ADD)


def order_pre_process(changes: DataFrame, dic: DataFrame, now: Column | None = None, wait: int = ORDER_WAIT) -> DataFrame:
    """Order lines with their order, activity, coupon and source name.

    The order contributes its insertion and its updates, so a line appears once per order change within the
    waiting time. Activity and coupon are optional. On tables these few columns are dealt out by order, so that the wide
    lines are not shuffled by their own id (nor once more for their payment).
    """
    amount = (money(field("sku_num")) * money(field("order_price"))).cast("string")
    lines = changes.where(routed("order_detail", "insert")).select(
        *fields("id", "order_id", "sku_id", "sku_name", "create_time", "source_id", "source_type", "sku_num"),
        amount.alias("split_original_amount"),
        *fields("split_total_amount", "split_activity_amount", "split_coupon_amount"),
        F.col("ts").alias("od_ts"),
        "event_time",
    )
    orders = changes.where(routed("order_info", "insert", "update")).select(
        field("id").alias("_order"),
        *fields("user_id", "province_id", "operate_time", "order_status"),
        "type",
        "old",
        F.col("ts").alias("oi_ts"),
        "event_time",
    )
    activity = changes.where(routed("order_detail_activity", "insert")).select(
        *fields("order_detail_id", "activity_id", "activity_rule_id"), "event_time"
    )
    coupon = changes.where(routed("order_detail_coupon", "insert")).select(*fields("order_detail_id", "coupon_id"), "event_time")
    rows = bounded_join(lines, orders, {"order_id": "_order"}, wait)
    by_line = {"id": "order_detail_id"}
    if not changes.isStreaming:
        activity, coupon = (beside(lines, extra, "id", "order_detail_id", "order_id", "_order") for extra in (activity, coupon))
        by_line["order_id"] = "_order"
    rows = bounded_join(rows, activity, by_line, wait, "left_outer")
    rows = bounded_join(rows, coupon, by_line, wait, "left_outer")
    rows = lookup(rows, dic, "source_type", "source_type_name")
    return (
        rows.withColumn("date_id", times.day(F.try_to_timestamp("create_time")))
        .withColumn("operate_date_id", times.day(F.try_to_timestamp("operate_time")))
        .withColumn("row_op_ts", times.now(now))
        .select(*schemas.ORDER_PRE_PROCESS)
    )


def order_details(pre: DataFrame) -> DataFrame:
    """Lines of new orders."""
    rows = pre.where(F.col("type") == "insert")
    return rows.withColumnsRenamed({"source_type": "source_type_code", "od_ts": "ts"}).select(*schemas.ORDER_DETAIL)


def order_cancels(pre: DataFrame) -> DataFrame:
    """Lines of orders that were cancelled."""
    rows = pre.where((F.col("type") == "update") & before("order_status").isNotNull() & (F.col("order_status") == ORDER_CANCELLED))
    rows = rows.drop("date_id").withColumnsRenamed(
        {"operate_date_id": "date_id", "operate_time": "cancel_time", "source_type": "source_type_code", "oi_ts": "ts"}
    )
    return rows.select(*schemas.ORDER_CANCEL_DETAIL)


def payments(details: DataFrame, changes: DataFrame, dic: DataFrame, wait: int | None = None) -> DataFrame:
    """Every line of a paid order. ``details`` is the order detail fact with its event time."""
    paid = changes.where(routed("payment_info", "update") & (field("payment_status") == PAYMENT_DONE)).select(
        field("order_id").alias("_order"),
        field("payment_type").alias("payment_type_code"),
        field("callback_time").alias("callback_time"),
        F.col("ts").alias("pay_ts"),
        "event_time",
    )
    rows = bounded_join(details.drop("ts"), paid, {"order_id": "_order"}, wait)
    rows = lookup(rows, dic, "payment_type_code", "payment_type_name")
    renamed = {"id": "order_detail_id", "split_total_amount": "split_payment_amount", "pay_ts": "ts"}
    return rows.withColumnsRenamed(renamed).select(*schemas.PAY_DETAIL_SUC)


def order_refunds(changes: DataFrame, dic: DataFrame, now: Column | None = None, wait: int = REFUND_WAIT) -> DataFrame:
    """Refund requests with the province of their order."""
    asked = changes.where(routed("order_refund_info", "insert")).select(
        *fields("id", "user_id", "order_id", "sku_id", "refund_num", "refund_amount", "refund_reason_txt", "create_time"),
        field("refund_type").alias("refund_type_code"),
        field("refund_reason_type").alias("refund_reason_type_code"),
        "ts",
        "event_time",
    )
    orders = changes.where(routed("order_info") & transitioned("order_status", ORDER_REFUNDING)).select(
        field("id").alias("_order"), *fields("province_id"), "event_time"
    )
    rows = bounded_join(asked, orders, {"order_id": "_order"}, wait)
    rows = lookup(rows, dic, "refund_type_code", "refund_type_name")
    rows = lookup(rows, dic, "refund_reason_type_code", "refund_reason_type_name")
    return (
        rows.withColumn("date_id", times.day(F.try_to_timestamp("create_time"))).withColumn("row_op_ts", times.now(now)).select(*schemas.ORDER_REFUND)
    )


def refund_payments(changes: DataFrame, dic: DataFrame, now: Column | None = None, wait: int | None = None) -> DataFrame:
    """Refunds that were paid out."""
    paid = changes.where(routed("refund_payment") & transitioned("refund_status", REFUND_PAYMENT_DONE)).select(
        *fields("id", "order_id", "sku_id", "callback_time", "total_amount"),
        field("payment_type").alias("payment_type_code"),
        "ts",
        "event_time",
    )
    orders = changes.where(routed("order_info") & transitioned("order_status", ORDER_REFUNDED)).select(
        field("id").alias("_order"), *fields("user_id", "province_id"), "event_time"
    )
    refunds = changes.where(routed("order_refund_info") & transitioned("refund_status", REFUND_INFO_PAID)).select(
        field("order_id").alias("_order"), field("sku_id").alias("_sku"), *fields("refund_num"), "event_time"
    )
    rows = bounded_join(paid, orders, {"order_id": "_order"}, wait)
    rows = bounded_join(rows, refunds, {"order_id": "_order", "sku_id": "_sku"}, wait)
    rows = lookup(rows, dic, "payment_type_code", "payment_type_name")
    return (
        rows.withColumn("date_id", times.day("callback_time")).withColumn("row_op_ts", times.now(now)).select(*schemas.REFUND_PAY_SUC)
    )

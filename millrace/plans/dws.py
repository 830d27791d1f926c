"""Summary jobs over tumbling windows. Inputs carry ``rowtime`` (and a watermark on streams) and ``seq``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import text
from millrace.functions.values import MONEY, TOTAL, flag, is_blank, money, or_zero
from millrace.operators.changes import DETAIL_PAGE, HOME_PAGE, is_keyword_search, is_login
from millrace.operators.dedup import latest_version
from millrace.operators.enrich import enrich, flatten_sku
from millrace.operators.unions import measures, union_all
from millrace.operators.visitors import RETURN_DAYS, first_per_day, first_time_per_day, login_days
from millrace.operators.windows import LENGTH, decorate, per_member, sums, tumble, tumble_distinct


def keyword_views(pages: DataFrame, length: str = LENGTH, now: Column | None = None, cut=text.words) -> DataFrame:
    """How often each keyword was searched for. ``cut`` turns a text into an array of keywords."""
    found = pages.where(is_keyword_search()).select(F.explode(cut(F.col("page.item"))).alias("keyword"), "rowtime")
    counted = tumble(found, [F.count(F.lit(1)).alias("keyword_count")], ["keyword"], length, now=now)
    return counted.withColumn("source", F.lit("search")).select(*schemas.KEYWORD_WINDOW)


_VIEW_MEASURES = ["uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct"]
_VIEW_DIMS = ["vc", "ch", "ar", "is_new"]


def page_view_measures(pages: DataFrame, visitors: DataFrame, jumps: DataFrame) -> DataFrame:
    """Three inputs as one: each row counts for the measures of its own input."""
    dims = ["rowtime", *[F.col(f"common.{d}").alias(d) for d in _VIEW_DIMS]]
    views = {"sv_ct": flag(is_blank("page.last_page_id")), "pv_ct": 1, "dur_sum": F.col("page.during_time")}
    return union_all(
        measures(pages, dims, _VIEW_MEASURES, views),
        measures(visitors, dims, _VIEW_MEASURES, {"uv_ct": 1}),
        measures(jumps, dims, _VIEW_MEASURES, {"uj_ct": 1}),
    )


def page_views(
    pages: DataFrame, visitors: DataFrame, jumps: DataFrame, length: str = LENGTH, now: Column | None = None
) -> DataFrame:
    """Visitors, sessions, views, time and bounces by version, channel, area and new-visitor flag."""
    rows = page_view_measures(pages, visitors, jumps)
    return tumble(rows, sums(*_VIEW_MEASURES), _VIEW_DIMS, length, now=now).select(*schemas.PAGE_VIEW_WINDOW)


def home_detail_views(pages: DataFrame, length: str = LENGTH, now: Column | None = None) -> DataFrame:
    """Daily unique visitors of the home and the product page."""
    rows = pages.where(F.col("page.page_id").isin(HOME_PAGE, DETAIL_PAGE)).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "rowtime", *(["seq"] if pages.isStreaming else [])
    )
    if rows.isStreaming:
        firsts = first_per_day(rows, "mid", also=["page_id"])
    else:
        firsts = first_time_per_day(rows, ["mid", "page_id"])
    counts = [
        F.sum(flag(F.col("page_id") == HOME_PAGE)).alias("home_uv_ct"),
        F.sum(flag(F.col("page_id") == DETAIL_PAGE)).alias("good_detail_uv_ct"),
    ]
    return tumble(firsts, counts, None, length, now=now).select(*schemas.HOME_DETAIL_WINDOW)


def user_logins(pages: DataFrame, length: str = LENGTH, now: Column | None = None, min_days: int = RETURN_DAYS) -> DataFrame:
    """Users of the day and users who are back after a long break."""
    logins = pages.where(is_login()).select(F.col("common.uid").alias("uid"), "rowtime")
    days = login_days(logins, "uid", min_days=min_days)
    return tumble(days, sums("back_ct", "uu_ct"), None, length, now=now).select(*schemas.USER_LOGIN_WINDOW)


def cart_users(carts: DataFrame, length: str = LENGTH, now: Column | None = None) -> DataFrame:
    """Users who put something into the cart for the first time of the day."""
    if carts.isStreaming:
        firsts = first_per_day(carts.select("user_id", "rowtime", "seq"), "user_id")
    else:
        firsts = first_time_per_day(carts, ["user_id"])
    count = [F.count(F.lit(1)).alias("cart_add_uu_ct")]
    return tumble(firsts, count, None, length, now=now).select(*schemas.CART_ADD_UU_WINDOW)


def latest_amounts(facts: DataFrame, dims: list[str], amounts: list[str]) -> DataFrame:
    """Latest version of every order line with the given dimensions and amounts, and nothing else.

    Amounts are decimals; optional reductions count as zero.
    """
    rows = facts.select(
        "id", "row_op_ts", "seq", "order_id", "rowtime", *dims, *[_AMOUNTS[a]().alias(a) for a in amounts]
    )
    return latest_version(rows, ["id"], "row_op_ts", "seq", ["id", "order_id", "rowtime", *dims, *amounts])


_AMOUNTS = {
    "order_origin_total_amount": lambda: money("split_original_amount"),
    "order_activity_reduce_amount": lambda: or_zero(money("split_activity_amount")).cast(MONEY),
    "order_coupon_reduce_amount": lambda: or_zero(money("split_coupon_amount")).cast(MONEY),
    "order_amount": lambda: money("split_total_amount"),
}
_SKU_AMOUNTS = list(_AMOUNTS)

#: Parts a product's orders are dealt out in.
ORDER_PARTS = 64


def sku_order_sums(facts: DataFrame, length: str = LENGTH, now: Column | None = None) -> DataFrame:
    """Orders, amounts and first-order users per product and window.

    A user's first order line of the day counts for the product it is of, so only the total over all products
    is a number of users.
    """
    rows = latest_amounts(facts, ["user_id", "sku_id"], _SKU_AMOUNTS)
    count = "order_uu_count"
    if rows.isStreaming:
        from millrace.streaming.stateful import flag_first_per_day

        flagged = flag_first_per_day(rows, ["user_id"], "rowtime", "id").withColumnRenamed("first", count)
        return tumble_distinct(flagged, ["sku_id"], "order_id", "order_count", [count, *_SKU_AMOUNTS], length, now=now)
    # a hot product is spread over parts of its orders; each part comes down to a row per window before a product's rows meet
    parted = rows.withColumn("_part", F.pmod(F.hash("order_id"), F.lit(ORDER_PARTS))).repartition("sku_id", "_part")
    orders = per_member(parted, ["sku_id", "_part"], "order_id", _SKU_AMOUNTS, length)
    orders = orders.groupBy("window", "sku_id", "_part").agg(F.count(F.lit(1)).alias("order_count"), *sums(*_SKU_AMOUNTS))
    orders = orders.select("window", "sku_id", F.lit(0).cast("long").alias(count), "order_count", *_SKU_AMOUNTS)
    day = F.to_date("rowtime").alias("day")
    users = rows.groupBy("user_id", day).agg(F.min(F.struct("rowtime", "id", "sku_id")).alias("first")).select("first.*")
    users = users.groupBy(F.window("rowtime", length).alias("window"), "sku_id").agg(F.count(F.lit(1)).alias(count))
    users = users.select(
        "window", "sku_id", count, F.lit(0).cast("long").alias("order_count"), *[F.lit(0).cast(orders.schema[c].dataType).alias(c) for c in _SKU_AMOUNTS]
    )
    # dealt out by product alone, the rows lie as the product dimension is joined
    both = union_all(orders, users).repartition("sku_id")
    total = both.groupBy("window", "sku_id").agg(*sums(count, "order_count", *_SKU_AMOUNTS))
    return decorate(total, now)


def sku_orders(
    facts: DataFrame, dims: dict[str, DataFrame], length: str = LENGTH, now: Column | None = None
) -> DataFrame:
    """Product summary with trademark, unit and categories. The dimensions join the few summary rows."""
    rows = sku_order_sums(facts, length, now)
    products = flatten_sku(dims)
    targets = {c: c for c in products.columns if c != "sku_id"}
    rows = enrich(rows, products, "sku_id", targets, dim_key="sku_id")
    return rows.withColumns({c: F.col(c).cast(TOTAL) for c in _SKU_AMOUNTS}).select(*schemas.SKU_ORDER_WINDOW)


def province_orders(facts: DataFrame, provinces: DataFrame, length: str = LENGTH, now: Column | None = None) -> DataFrame:
    """Orders and amount per province and window; an unknown province keeps an empty name."""
    rows = latest_amounts(facts, ["province_id"], ["order_amount"])
    rows = tumble_distinct(rows, ["province_id"], "order_id", "order_count", ["order_amount"], length, now=now)
    rows = enrich(rows, provinces, "province_id", {"name": "province_name"})
    rows = rows.withColumn("province_name", F.coalesce("province_name", F.lit("")))
    return rows.withColumn("order_amount", F.col("order_amount").cast(TOTAL)).select(*schemas.PROVINCE_ORDER_WINDOW)

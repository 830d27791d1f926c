"""Serving queries over the summaries.

``rows`` is a summary as it is stored: with the day partition ``dt`` and possibly several versions of a row.
Every query reads the largest version only.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schemas import SUMMARY_KEYS
from millrace.sinks.tables import latest, with_day

# Defaults and labels of the serving queries.
TOP_CHANNELS = 20
STATUS_OK = 0
AMOUNT_LABEL = "交易额"


def day_or_today(date: int | None) -> Column:
    """The given day (20220917), or today where it is missing or 0."""
    return F.lit(date) if date else F.date_format(F.current_date(), "yyyyMMdd").cast("int")


def of_day(rows: DataFrame, table: str, date: int | None) -> DataFrame:
    """Current rows of one day. The filter is on the partition column, before versions are compared."""
    if "dt" not in rows.columns:
        rows = with_day(rows)
    return latest(rows.where(F.col("dt") == day_or_today(date)), SUMMARY_KEYS[table])


def rows_of_day(rows: DataFrame, date: int | None, ts: str = "rowtime", follow_seconds: int = 0) -> DataFrame:
    """Input rows of one day, for a summary that is computed for that day alone: a time range that Catalyst moves below the
    windows. ``follow_seconds`` adds what a pattern has to see of the next day. All versions of a row share its time."""
    begin = F.to_timestamp(day_or_today(date).cast("string"), "yyyyMMdd")
    return rows.where((F.col(ts) >= begin) & (F.unix_seconds(ts) < F.unix_seconds(begin + F.expr("INTERVAL 1 DAY")) + follow_seconds))


def gmv(province_orders: DataFrame, date: int | None = None) -> DataFrame:
    """Amount of a day: one row, null when the day has none."""
    rows = of_day(province_orders, "dws_trade_province_order_window", date)
    return rows.agg(F.sum("order_amount").cast("decimal(38,2)").alias("order_amount"))


def province_amounts(province_orders: DataFrame, date: int | None = None) -> DataFrame:
    rows = of_day(province_orders, "dws_trade_province_order_window", date)
    return rows.groupBy("province_name").agg(F.sum("order_amount").cast("decimal(38,2)").alias("order_amount"))


def top_channels(page_views: DataFrame, date: int | None = None, limit: int = TOP_CHANNELS) -> DataFrame:
    """Channels by unique visitors, the largest first; equal ones by name."""
    rows = of_day(page_views, "dws_traffic_vc_ch_ar_is_new_page_view_window", date)
    counted = rows.groupBy("ch").agg(F.sum("uv_ct").alias("uv_ct")).where(F.col("uv_ct") > 0)
    return counted.orderBy(F.desc("uv_ct"), "ch").limit(limit)


def gmv_payload(province_orders: DataFrame, date: int | None = None) -> DataFrame:
    row = F.struct(F.lit(STATUS_OK).alias("status"), F.col("order_amount").alias("data"))
    return gmv(province_orders, date).select(F.to_json(row, {"ignoreNullFields": "false"}).alias("payload"))


def _pairs(rows: DataFrame, name: str, value: str, order: list[Column]) -> Column:
    """Name and value of all rows as one array. Used on results that are a handful of rows by nature."""
    ordered = F.array_sort(F.collect_list(F.struct(*order, F.struct(F.col(name).alias("name"), F.col(value).alias("value")).alias("_p"))))
    return F.transform(ordered, lambda p: p["_p"])


def province_payload(province_orders: DataFrame, date: int | None = None) -> DataFrame:
    """All provinces of a day; their number is that of the province dimension."""
    rows = province_amounts(province_orders, date)
    pairs = rows.agg(_pairs(rows, "province_name", "order_amount", [F.col("province_name").alias("o")]).alias("pairs"))
    data = F.struct(F.col("pairs").alias("mapData"), F.lit(AMOUNT_LABEL).alias("valueName"))
    return pairs.select(F.to_json(F.struct(F.lit(STATUS_OK).alias("status"), data.alias("data"))).alias("payload"))


def channel_payload(page_views: DataFrame, date: int | None = None, limit: int = TOP_CHANNELS) -> DataFrame:
    rows = top_channels(page_views, date, limit)
    order = [(-F.col("uv_ct")).alias("o1"), F.col("ch").alias("o2")]
    pairs = rows.agg(_pairs(rows, "ch", "uv_ct", order).alias("data"))
    return pairs.select(F.to_json(F.struct(F.lit(STATUS_OK).alias("status"), F.col("data"))).alias("payload"))

"""Explicit schemas of the inputs and column lists of the outputs."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_TEXT_MAP = T.MapType(T.StringType(), T.StringType())

#: Change envelope of a source database.
CDC = T.StructType(
    [
        *_strings("database", "table", "type", "ts").fields,
        T.StructField("old", _TEXT_MAP),
        T.StructField("data", _TEXT_MAP),
    ]
)

#: Click log: one record per page view or per app start.
TRAFFIC_LOG = T.StructType(
    [
        T.StructField("common", _strings("mid", "uid", "vc", "ch", "ar", "is_new")),
        T.StructField(
            "page",
            T.StructType(
                [
                    *_strings("page_id", "last_page_id", "item", "item_type").fields,
                    T.StructField("during_time", T.LongType()),
                ]
            ),
        ),
        T.StructField("start", _TEXT_MAP),
        T.StructField("err", _TEXT_MAP),
        T.StructField("displays", T.ArrayType(_TEXT_MAP)),
        T.StructField("actions", T.ArrayType(_TEXT_MAP)),
        T.StructField("ts", T.LongType()),
    ]
)

#: One record of the table that configures the dimension job.
TABLE_CONFIG = _strings("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extended")

#: Change record over that table.
CONFIG_CHANGE = T.StructType(
    [
        T.StructField("op", T.StringType()),
        T.StructField("before", TABLE_CONFIG),
        T.StructField("after", TABLE_CONFIG),
    ]
)

# Output columns, in the order in which the sinks bind them.
CART_ADD = ["id", "user_id", "sku_id", "sku_num", "source_type_code", "source_type_name", "ts"]

ORDER_PRE_PROCESS = [
    "id", "order_id", "sku_id", "sku_name", "date_id", "create_time", "source_id", "source_type", "sku_num",
    "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount", "od_ts",
    "user_id", "province_id", "operate_date_id", "operate_time", "order_status", "type", "old", "oi_ts",
    "activity_id", "activity_rule_id", "coupon_id", "source_type_name", "row_op_ts",
]

ORDER_DETAIL = [
    "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
    "coupon_id", "date_id", "create_time", "source_id", "source_type_code", "source_type_name", "sku_num",
    "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount", "ts",
    "row_op_ts",
]

ORDER_CANCEL_DETAIL = ["cancel_time" if c == "create_time" else c for c in ORDER_DETAIL]

PAY_DETAIL_SUC = [
    "order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "payment_type_code", "payment_type_name", "callback_time", "source_id",
    "source_type_code", "source_type_name", "sku_num", "split_original_amount", "split_activity_amount",
    "split_coupon_amount", "split_payment_amount", "ts", "row_op_ts",
]

ORDER_REFUND = [
    "id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time", "refund_type_code",
    "refund_type_name", "refund_reason_type_code", "refund_reason_type_name", "refund_reason_txt", "refund_num",
    "refund_amount", "ts", "row_op_ts",
]

REFUND_PAY_SUC = [
    "id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code", "payment_type_name", "date_id",
    "callback_time", "refund_num", "total_amount", "ts", "row_op_ts",
]

KEYWORD_WINDOW = ["stt", "edt", "source", "keyword", "keyword_count", "ts"]
PAGE_VIEW_WINDOW = ["stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct", "ts"]
HOME_DETAIL_WINDOW = ["stt", "edt", "home_uv_ct", "good_detail_uv_ct", "ts"]
USER_LOGIN_WINDOW = ["stt", "edt", "back_ct", "uu_ct", "ts"]
CART_ADD_UU_WINDOW = ["stt", "edt", "cart_add_uu_ct", "ts"]
SKU_ORDER_WINDOW = [
    "stt", "edt", "trademark_id", "trademark_name", "category1_id", "category1_name", "category2_id",
    "category2_name", "category3_id", "category3_name", "sku_id", "sku_name", "spu_id", "spu_name",
    "order_uu_count", "order_count", "order_origin_total_amount", "order_activity_reduce_amount",
    "order_coupon_reduce_amount", "order_amount", "ts",
]
PROVINCE_ORDER_WINDOW = ["stt", "edt", "province_id", "province_name", "order_count", "order_amount", "ts"]

#: Columns by which a summary row replaces an older version of itself.
SUMMARY_KEYS = {
    "dws_traffic_source_keyword_page_view_window": ["stt", "edt", "source", "keyword"],
    "dws_traffic_vc_ch_ar_is_new_page_view_window": ["stt", "edt", "vc", "ch", "ar", "is_new"],
    "dws_traffic_home_detail_page_view_window": ["stt", "edt"],
    "dws_user_user_login_window": ["stt", "edt"],
    "dws_trade_cart_add_uu_window": ["stt", "edt"],
    "dws_trade_sku_order_window": ["stt", "edt", "sku_id", "sku_name", "spu_id", "spu_name"],
    "dws_trade_province_order_window": ["stt", "edt", "province_id"],
}

SUMMARY_COLUMNS = {
    "dws_traffic_source_keyword_page_view_window": KEYWORD_WINDOW,
    "dws_traffic_vc_ch_ar_is_new_page_view_window": PAGE_VIEW_WINDOW,
    "dws_traffic_home_detail_page_view_window": HOME_DETAIL_WINDOW,
    "dws_user_user_login_window": USER_LOGIN_WINDOW,
    "dws_trade_cart_add_uu_window": CART_ADD_UU_WINDOW,
    "dws_trade_sku_order_window": SKU_ORDER_WINDOW,
    "dws_trade_province_order_window": PROVINCE_ORDER_WINDOW,
}


def summary_types(name: str) -> str:
    """Declared types of a summary: amounts are decimals, counts, sums and versions are longs, the rest is text."""

    def kind(column: str) -> str:
        if column.endswith("_amount"):
            return "decimal(38,2)"
        return "long" if column in ("ts", "dur_sum") or column.endswith(("_ct", "_count")) else "string"

    return ", ".join(f"{c} {kind(c)}" for c in SUMMARY_COLUMNS[name])


#: Input schema of the order detail fact as it is read back from its topic.
ORDER_DETAIL_FACT = _strings(*ORDER_DETAIL)

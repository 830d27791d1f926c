"""Filters over change envelopes and click logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import is_blank, not_blank

# Markers a full snapshot puts around its rows.
SNAPSHOT_MARKERS = ["bootstrap-start", "bootstrap-complete"]

# Page and item codes of the click log.
HOME_PAGE = "home"
DETAIL_PAGE = "good_detail"
LOGIN_PAGE = "login"
SEARCH_PAGE = "search"
KEYWORD_ITEM = "keyword"


def clean_changes(df: DataFrame) -> DataFrame:
    """Rows with readable data that are no snapshot markers."""
    kind = F.coalesce("type", F.lit(""))
    return df.where(F.col("data").isNotNull() & ~kind.isin(SNAPSHOT_MARKERS))


def entry_page(last_page: str = "page.last_page_id") -> Column:
    return is_blank(last_page)


def is_login(uid: str = "common.uid", last_page: str = "page.last_page_id") -> Column:
    return not_blank(uid) & ((F.col(last_page) == LOGIN_PAGE) | is_blank(last_page))


def is_keyword_search(page: str = "page") -> Column:
    return (
        (F.col(f"{page}.last_page_id") == SEARCH_PAGE)
        & (F.col(f"{page}.item_type") == KEYWORD_ITEM)
        & F.col(f"{page}.item").isNotNull()
    )

"""Small null-safe value expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(16,2)"
TOTAL = "decimal(38,2)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_blank(value: Column | str) -> Column:
    """True for null and for the empty string."""
    return F.coalesce(_col(value), F.lit("")) == F.lit("")


def not_blank(value: Column | str) -> Column:
    return ~is_blank(value)


def money(value: Column | str) -> Column:
    return _col(value).try_cast(MONEY)


def or_zero(value: Column | str) -> Column:
    return F.coalesce(_col(value), F.lit(0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 elsewhere (null included)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")


def listed(names: Column | str, name: Column | str) -> Column:
    """Is ``name`` an element of the comma list ``names``?"""
    return F.array_contains(F.split(_col(names), ","), _col(name))


def joined_key(*parts: Column | str) -> Column:
    return F.concat_ws("_", *[_col(p) for p in parts])


def once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and the given columns, each evaluated a single time per row.

    An expensive expression such as a JSON parse is otherwise copied by the optimizer into every filter and
    field access above it. Generated rows stop that: one array entry per row, taken apart again.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.inline(F.array(made)))

"""Column expressions over the change envelope ``table, type, ts, data, old``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(name: str) -> Column:
    return F.col("data")[name]


def fields(*names: str) -> list[Column]:
    return [field(n).alias(n) for n in names]


def before(name: str) -> Column:
    """Value before the change; null when the key is absent, that is, unchanged."""
    return F.col("old")[name]


def routed(table: str, *types: str) -> Column:
    match = F.col("table") == table
    return match & F.col("type").isin(*types) if types else match


def transitioned(name: str, code: str) -> Column:
    """The row was updated, ``name`` took part in the update and is ``code`` now."""
    return (F.col("type") == "update") & before(name).isNotNull() & (field(name) == code)


def grew(name: str) -> Column:
    """An update raised the integer ``name``. Text that is no integer counts as not raised."""
    return (
        (F.col("type") == "update")
        & before(name).isNotNull()
        & (field(name).try_cast("int") > before(name).try_cast("int"))
    )


def added(name: str) -> Column:
    """Inserted value, or the difference an update made, as text."""
    gap = field(name).try_cast("int") - before(name).try_cast("int")
    return F.when(F.col("type") == "insert", field(name)).otherwise(gap.cast("string"))

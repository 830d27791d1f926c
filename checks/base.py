from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import INPUTS
from millrace.session import checkpoint_root, tune

NOW_MS = 1_700_000_000_000


def now_ms():
    """Stand-in for the wall clock, so that results can be compared."""
    return F.lit(NOW_MS).cast("long")


def now_ts():
    return F.timestamp_millis(now_ms())


def scratch(spark) -> str:
    """A new folder beside the checkpoints, in shared storage on a cluster."""
    return f"{checkpoint_root(spark)}/run-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Check:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Check] = {}


def with_inputs(body: str) -> str:
    """Prefix a SQL text with the derived inputs it names, and those they name in turn."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & INPUTS.keys() - needed:
            needed.add(name)
            todo.append(INPUTS[name])
    if not needed:
        return body
    parts = [f"{name} AS ({text})" for name, text in INPUTS.items() if name in needed]
    return f"WITH {', '.join(parts)}\n{body}"


def check(name: str, sql: str | None = None):
    """Register a query under ``name``."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        if name in CATALOG:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tune(spark), folder)

        CATALOG[name] = Check(name, run, with_inputs(sql) if sql else None)
        return fn

    return add

"""Aggregates of one's own: a state that rows are added to, that merges with others, and that ends in a result."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

#: Keys a task holds states of before it hands them on.
KEYS = 100_000


def accumulate(
    df: DataFrame,
    keys: list[str],
    create: Callable[[], Any],
    add: Callable[[Any, pd.DataFrame], Any],
    merge: Callable[[Any, Any], Any],
    result: Callable[[Any], dict],
    state: str,
    returns: str,
) -> DataFrame:
    """One row per key: the key and ``result`` (columns ``returns``).

    ``add`` takes a state and some rows of one key, ``merge`` two states in any order. A state is a tuple with the types
    ``state`` (as in a schema string). Every task reduces its own rows first, so what is shuffled is one state per key and
    task (more where a task has very many keys), and a key that holds most rows is spread over all tasks.
    """
    key_types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    names = [part.split()[0] for part in state.split(", ")]

    def rows_of(states: dict[tuple, Any]) -> pd.DataFrame:
        return pd.DataFrame([(*k, *s) for k, s in states.items()], columns=[*keys, *names])

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict[tuple, Any] = {}
        for batch in batches:
            for key, rows in batch.groupby(keys, dropna=False, sort=False):
                key = tuple(None if pd.isna(k) else k for k in key)
                states[key] = add(states[key] if key in states else create(), rows)
            if len(states) > KEYS:
                yield rows_of(states)
                states = {}
        if states:
            yield rows_of(states)

    def finish(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = create()
        for own in rows[names].itertuples(index=False, name=None):
            total = merge(total, own)
        return pd.DataFrame([dict(zip(keys, key, strict=True)) | result(total)])

    partial = df.mapInPandas(reduce, f"{key_types}, {state}")
    return partial.groupBy(*keys).applyInPandas(finish, f"{key_types}, {returns}")

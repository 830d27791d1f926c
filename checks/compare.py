"""Run registered queries against their SQL: ``python -m checks.compare [folder] [name part ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    return (type(v).__name__, v)


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(spark, con, entry, folder: str) -> str | None:
    """None where query and SQL agree, else a description. Values and their types have to agree."""
    df = entry.run(spark, folder)
    got = _rows(df.columns, df.collect())
    cursor = con.execute(entry.sql)
    names = [d[0] for d in cursor.description]
    want = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return None if got else "no rows on either side"
    missing, extra = want - got, got - want
    sample = f"missing {list(missing)[:2]} extra {list(extra)[:2]}"
    return f"{sum(got.values())} rows against {sum(want.values())}; {sum(missing.values())} missing; {sample}"


def main(argv: list[str]) -> int:
    from checks import CATALOG
    from millrace import build_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    bad = 0
    for name, entry in CATALOG.items():
        if argv[1:] and not any(part in name for part in argv[1:]):
            continue
        began = time.time()
        try:
            problem = differences(spark, con, entry, folder) if entry.sql else f"rows only: {entry.run(spark, folder).count()}"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(problem) and bool(entry.sql)
        print(f"{'ok ' if not problem else 'BAD'} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

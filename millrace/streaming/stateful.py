"""Stateful operators on streams.

Rows enter a processor as ``(key, order columns, payload)``: days and epochs are computed by Spark
beforehand and the row itself travels as one JSON text, so Python only compares a few scalars per row.

Processors that hold rows back emit them once the watermark has passed the row. Their input therefore needs a
watermark delay of the out-of-orderness plus the holding time (``hold_delay``), and what they emit is still
on time for a window further down.
"""

from __future__ import annotations

import itertools
import json
import pickle
from collections.abc import Iterator
from decimal import Decimal
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, DateType, IntegralType, StringType, StructType, TimestampType

from millrace.functions import times

# Out-of-orderness of the inputs, settling time of duplicates, life of a day's state.
OUT_OF_ORDER_SECONDS = 3
SETTLE_SECONDS = 5
DAY_MILLIS = 24 * 60 * 60 * 1000
#: The longest day there is, where clocks are put back.
LONGEST_DAY_MILLIS = 25 * 60 * 60 * 1000

#: Buckets of keys whose state is read and written together, for each day or time slice. A call to the state store costs the
#: same for one key as for a bucket, so a day of many visitors takes a bounded number of calls. Part of the state's layout: a
#: running query keeps the number it was started with.
BUCKETS = 1024

#: Clocks of timers and of the life of state: the watermark, or the time of the machine.
EVENT, PROCESSING = "EventTime", "ProcessingTime"

_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def hold_delay(hold_seconds: int, out_of_order_seconds: int = OUT_OF_ORDER_SECONDS) -> str:
    return f"{hold_seconds + out_of_order_seconds} seconds"


def _run(
    df: DataFrame,
    keys: list[Column],
    processor: StatefulProcessor,
    ts: str,
    seq: Column | str,
    scalars: dict[str, Column],
    extra: str = "",
    mode: str = "EventTime",
    emitted: Column | None = None,
) -> DataFrame:
    """Pack rows, run the processor per key, unpack the rows it emits (plus the columns in ``extra``).

    ``emitted`` holds for the rows that may come out; the others travel without a payload and are only there to be seen.
    """
    names = df.columns
    key_names = [f"_key{i}" for i in range(len(keys))]
    payload = F.to_json(F.struct(*[c for c in names if c != ts]), _JSON)
    packed = df.select(
        *[k.alias(n) for k, n in zip(keys, key_names)],
        F.col(ts).alias("_ts"),
        F.unix_micros(ts).alias("_micros"),
        (seq if isinstance(seq, Column) else F.col(seq)).alias("_seq"),
        *[c.alias(n) for n, c in scalars.items()],
        (payload if emitted is None else F.when(emitted, payload)).alias("_payload"),
    )
    schema = "_ts timestamp, _payload string" + (f", {extra}" if extra else "")
    out = packed.groupBy(*key_names).transformWithState(
        processor, schema, "append", mode, None, "_ts" if mode == "EventTime" else ""
    )
    body = StructType([f for f in df.schema.fields if f.name != ts])
    added = [c for c in out.columns if c not in ("_ts", "_payload")]
    out = out.select(F.col("_ts").alias(ts), F.from_json("_payload", body, _JSON).alias("_row"), *added)
    return out.select(*[F.col(ts) if c == ts else F.col("_row")[c].alias(c) for c in names], *added)


def _bucketed(keys: list[str]) -> tuple[Column, Column]:
    """(bucket of a key, the key itself as one text)."""
    who = F.to_json(F.struct(*keys), _JSON)
    return F.pmod(F.xxhash64(who), F.lit(BUCKETS)).cast("int"), who


def _at(row: Row) -> tuple:
    """Place of a row in time order."""
    return (-1 if row["_micros"] is None else row["_micros"], _rank(row["_seq"]))


def _in_order(rows: Iterator[Row]) -> list[Row]:
    return sorted(rows, key=_at)


def _plain(seq):
    """A struct comes as a dictionary and is kept as a tuple, in the order of its fields."""
    return tuple(map(_plain, seq.values())) if isinstance(seq, dict) else seq


def _rank(seq) -> tuple:
    """Order of arrival as on tables: by the column's own type, structs field by field, missing values first."""
    seq = _plain(seq)
    if seq is None:
        return (0,)
    return (1, tuple(map(_rank, seq))) if isinstance(seq, tuple) else (1, seq)


class _FirstOfDay(StatefulProcessor):
    """The keys of a bucket and day that have been seen; they are dropped a day after the first row of them."""

    def __init__(self, flag: bool):
        self._flag = flag

    def init(self, handle) -> None:
        self._handle = handle
        self._seen = handle.getListState("seen", "who string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = {r[0] for r in self._seen.get()}
        best: dict[str, tuple] = {}
        for row in rows:
            who, later = row["_who"], row
            if who not in known:
                at = _at(row)
                if who not in best:
                    best[who], later = (at, row), None
                elif at < best[who][0]:
                    later, best[who] = best[who][1], (at, row)
            if self._flag and later is not None:
                yield Row(_ts=later["_ts"], _payload=later["_payload"], first=0)
        if best:
            self._seen.appendList([(who,) for who in best])
            micros = [row["_micros"] for _, row in best.values() if row["_micros"] is not None]
            # without a time there is nothing to count from: the entries stay
            if micros and not known:
                self._handle.registerTimer(min(micros) // 1000 + LONGEST_DAY_MILLIS)
        for _, row in best.values():
            if self._flag:
                yield Row(_ts=row["_ts"], _payload=row["_payload"], first=1)
            else:
                yield Row(_ts=row["_ts"], _payload=row["_payload"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._seen.clear()
        return iter(())

    def close(self) -> None:
        pass


class _FirstOfDayByClock(StatefulProcessor):
    """As ``_FirstOfDay``, but the entry lives for a day of the machine's clock. Nothing depends on a watermark, so no row is late."""

    def init(self, handle) -> None:
        self._seen = handle.getValueState("seen", "seen boolean", DAY_MILLIS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if not self._seen.exists():
            self._seen.update((True,))
            row = _in_order(rows)[0]
            yield Row(_ts=row["_ts"], _payload=row["_payload"])

    def close(self) -> None:
        pass


def first_per_day_stream(df: DataFrame, keys: list[str], ts: str, seq: str, clock: str = EVENT) -> DataFrame:
    """First row of every key and day. A row of an earlier day that comes late is judged by its own day.

    With ``clock=PROCESSING`` a row is never dropped as late, and rows without a time are a day of their own; a key's row
    that comes more than a day of real time after the first one of its day counts as a first one again.
    """
    if clock == PROCESSING:
        return _run(df, [*map(F.col, keys), times.day(ts)], _FirstOfDayByClock(), ts, seq, {}, mode=PROCESSING)
    bucket, who = _bucketed(keys)
    return _run(df, [times.day(ts), bucket], _FirstOfDay(False), ts, seq, {"_who": who})


def flag_first_per_day(df: DataFrame, keys: list[str], ts: str, seq: str) -> DataFrame:
    """All rows, with ``first`` = 1 on the first row of every key and day and 0 elsewhere."""
    bucket, who = _bucketed(keys)
    return _run(df, [times.day(ts), bucket], _FirstOfDay(True), ts, seq, {"_who": who}, "first long")


class _NewVisitor(StatefulProcessor):
    """Origin dates of the visitors of a bucket, each set once and kept for good, by a key of its own.

    Rows without a payload are seen and not emitted; the others say "new", all have a time.
    """

    def init(self, handle) -> None:
        self._origin = handle.getMapState("origin", "who string", "day string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen = pd.concat(list(rows), ignore_index=True)
        earliest = seen["micros"] == seen.groupby("who")["micros"].transform("min")
        heads: dict[str, tuple] = {}
        for who, seq, is_new, day, before in seen.loc[earliest, ["who", "seq", "is_new", "day", "day_before"]].itertuples(index=False, name=None):
            at = _rank(json.loads(seq, parse_float=Decimal))
            if who not in heads or at < heads[who][0]:
                heads[who] = (at, day if is_new == "1" else before)
        origins = {}
        for who, (_, day) in heads.items():
            known = self._origin.getValue((who,))
            if known is None:
                self._origin.updateValue((who,), (day,))
            origins[who] = day if known is None else known[0]
        out = seen[seen["payload"].notna()]
        if len(out):
            stale = out["day"] != out["who"].map(origins)
            yield pd.DataFrame({"micros": out["micros"], "payload": out["payload"], "fixed": stale.map({True: "0", False: "1"})})

    def close(self) -> None:
        pass


def repair_new_visitor_stream(df: DataFrame, ts: str, seq: str, out: str, may_change: Column) -> DataFrame:
    """Stream side of ``visitors.repair_new_visitor``; expects ``_key`` and ``_is_new``.

    Only rows that ``may_change`` travel through the processor as a whole. Of the others it sees what tells a visitor's origin;
    they pass straight through beside it. A row without a time, such as unreadable text, doesn't reach it at all.
    """
    # names as they are kept on the way to pandas, where a leading underscore would be lost
    names = [c for c in df.columns if c not in (ts, "_key", "_is_new")]
    bucket, who = _bucketed(["_key"])
    seen = df.where(F.col(ts).isNotNull()).select(
        bucket.alias("bucket"),
        who.alias("who"),
        F.unix_micros(ts).alias("micros"),
        F.to_json(F.struct(seq), {**_JSON, "ignoreNullFields": "false"}).alias("seq"),
        F.col("_is_new").alias("is_new"),
        times.day(ts).alias("day"),
        times.day_before(ts).alias("day_before"),
        F.when(may_change, F.to_json(F.struct(*names), _JSON)).alias("payload"),
    )
    rows = seen.groupBy("bucket").transformWithStateInPandas(_NewVisitor(), "micros long, payload string, fixed string", "append", "None")
    body = StructType([df.schema[c] for c in names])
    rows = rows.select(F.timestamp_micros("micros").alias(ts), F.from_json("payload", body, _JSON).alias("_row"), "fixed")
    kept = [c for c in df.columns if c not in ("_key", "_is_new")]
    fixed = rows.select(*[F.col(ts) if c == ts else F.col("_row")[c].alias(c) for c in kept], F.col("fixed").alias(out))
    passed = df.where(~may_change).withColumn(out, F.col("_is_new")).drop("_key", "_is_new")
    return fixed.unionByName(passed)


class _Login(StatefulProcessor):
    """Last login day of a user, kept for good."""

    def __init__(self, min_days: int):
        self._min_days = min_days

    def init(self, handle) -> None:
        self._last = handle.getValueState("last", "day int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self._last.get()[0] if self._last.exists() else None
        for row in _in_order(rows):
            today = row["_day_no"]
            if today == last:
                continue
            back = int(last is not None and today - last >= self._min_days)
            last = today
            self._last.update((today,))
            yield Row(_ts=row["_ts"], _payload=row["_payload"], uu_ct=1, back_ct=back)

    def close(self) -> None:
        pass


def login_days_stream(df: DataFrame, key: str, ts: str, min_days: int) -> DataFrame:
    rows = df.select(key, ts).where(F.col(ts).isNotNull())
    scalars = {"_day_no": F.unix_date(F.to_date(ts))}
    return _run(rows, [F.col(key)], _Login(min_days), ts, F.lit(0), scalars, "uu_ct long, back_ct long")


def _newer(kept: tuple | None, row: Row) -> tuple:
    """Version, payload and time of what stays of ``kept`` and ``row``: the larger version, or of equal ones the later row."""
    version = row["_version"] if row["_version"] is not None else -(2**63)
    return (version, row["_payload"], row["_ts"]) if kept is None or kept[0] <= version else kept


class _Settle(StatefulProcessor):
    """Latest version of a key, held from its first row until the settling time is over. A row without a time sets no timer of
    its own: alone, it leaves as soon as the watermark moves."""

    def init(self, handle) -> None:
        self._handle = handle
        self._kept = handle.getValueState("kept", "version long, payload string, ts timestamp, due long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._kept.get() if self._kept.exists() else None
        kept, due = (tuple(held[:3]), held[3]) if held else (None, None)
        for row in sorted(rows, key=lambda r: _rank(r["_seq"])):
            kept = _newer(kept, row)
            at = 0 if row["_micros"] is None else row["_micros"] // 1000
            if due is None or at < due:
                if due is not None and self._kept.exists():
                    self._handle.deleteTimer(due)
                due = at
        self._kept.update((*kept, due))
        self._handle.registerTimer(due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self._kept.exists():
            _, payload, ts, _ = self._kept.get()
            self._kept.clear()
            yield Row(_ts=ts, _payload=payload)

    def close(self) -> None:
        pass


class _SettleByClock(StatefulProcessor):
    """Latest version of a key, held for some seconds of the machine's clock from the arrival of its first row."""

    def __init__(self, seconds: int):
        self._millis = seconds * 1000

    def init(self, handle) -> None:
        self._handle = handle
        self._kept = handle.getValueState("kept", "version long, payload string, ts timestamp")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        kept = tuple(self._kept.get()) if self._kept.exists() else None
        if kept is None:
            self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self._millis)
        for row in sorted(rows, key=lambda r: _rank(r["_seq"])):
            kept = _newer(kept, row)
        self._kept.update(kept)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self._kept.exists():
            _, payload, ts = self._kept.get()
            self._kept.clear()
            yield Row(_ts=ts, _payload=payload)

    def close(self) -> None:
        pass


def settle_latest(df: DataFrame, keys: list[str], version: str, seq: str, ts: str = "rowtime", clock: str = EVENT, seconds: int = SETTLE_SECONDS) -> DataFrame:
    """Stream side of ``dedup.latest_version``; input delay ``hold_delay(SETTLE_SECONDS)``.

    With ``clock=PROCESSING`` a key's rows settle for ``seconds`` of real time, counted from the arrival of the first of them;
    no watermark is needed and no row is late.
    """
    scalars = {"_version": F.coalesce(F.unix_micros(times.version_time(version)), F.lit(-(1 << 62)))}
    processor = _SettleByClock(seconds) if clock == PROCESSING else _Settle()
    return _run(df, list(map(F.col, keys)), processor, ts, seq, scalars, mode=clock)


class _Bounce(StatefulProcessor):
    """Rows of a time slice, of the visitors of a bucket, that the watermark has not passed yet, and the verdict on those it has.

    ``own`` marks the rows of the slice; the others belong to the start of the next one and are only there to be seen. Every
    row that waits has a timer at its time or before.
    """

    def __init__(self, within_seconds: int, seq_type: str):
        self._within = within_seconds * 1_000_000
        self._seq_type = seq_type

    def init(self, handle) -> None:
        self._handle = handle
        self._rows = handle.getListState("rows", f"who string, micros long, seq {self._seq_type}, entry boolean, own boolean, ts timestamp, payload string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r["_who"], r["_micros"], _plain(r["_seq"]), r["_entry"], r["_own"], r["_ts"], r["_payload"]) for r in rows]
        self._rows.appendList(new)
        self._handle.registerTimer(min(r[1] for r in new) // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        limit = timerValues.getCurrentWatermarkInMs()
        rows = sorted(map(tuple, self._rows.get()), key=lambda r: (r[0], r[1], _rank(r[2])))
        rest = [r for r in rows if r[1] // 1000 > limit]
        if len(rest) == len(rows):
            return  # an earlier timer has seen to them
        if rest:
            self._rows.put(rest)
            self._handle.registerTimer(min(r[1] for r in rest) // 1000)
        else:
            self._rows.clear()
        for row, follow in zip(rows, [*rows[1:], None]):
            if row[3] and row[4] and row[1] // 1000 <= limit:
                if follow is None or follow[0] != row[0] or follow[1] - row[1] >= self._within:
                    yield Row(_ts=row[5], _payload=row[6], kind="timeout")
                elif follow[3]:
                    yield Row(_ts=row[5], _payload=row[6], kind="match")

    def close(self) -> None:
        pass


def verdicts_stream(df: DataFrame, key: str, ts: str, seq: str, within_seconds: int, slices: list[str]) -> DataFrame:
    """Stream side of ``bounce.verdicts``; input delay ``hold_delay(within_seconds)``. ``df`` is cut into ``slices``: the slice
    a row is shown to, whether it is its own, and whether the row is an entry."""
    shown, own, entry = slices
    bucket, who = _bucketed([key])
    scalars = {"_who": who, "_entry": F.col(entry), "_own": F.col(own)}
    processor = _Bounce(within_seconds, df.schema[seq].dataType.simpleString())
    return _run(df, [F.col(shown), bucket], processor, ts, seq, scalars, "kind string", emitted=F.col(entry) & F.col(own)).drop(*slices)


#: Pairs of a join handed on together, and rows of one entry of its state.
PAIRS = HELD_ROWS = 100_000


def _pairs(left: pd.DataFrame, right: pd.DataFrame, wait: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the rows of one key that are at most ``wait`` apart, some PAIRS at a time: a key's pairs are never all held."""
    if not len(left) or not len(right):
        return
    who = pd.factorize(pd.concat([left["who"], right["who"]], ignore_index=True))[0].astype(np.int64)
    own, other = who[: len(left)], who[len(left) :]
    at, theirs = left["micros"].to_numpy(), right["micros"].to_numpy()
    # a partner's key and the rank of its time in one number, so that those of a row are a range
    times_of, rank = np.unique(theirs, return_inverse=True)
    places = (other << 32) + rank
    order = np.argsort(places, kind="stable")
    places = places[order]
    low = np.searchsorted(places, (own << 32) + np.searchsorted(times_of, at - wait, "left"))
    high = np.searchsorted(places, (own << 32) + np.searchsorted(times_of, at + wait, "right"))
    ends = np.cumsum(high - low)
    for start in range(0, int(ends[-1]), PAIRS):
        place = np.arange(start, min(start + PAIRS, int(ends[-1])))
        row = np.searchsorted(ends, place, "right")
        yield row, order[high[row] - (ends[row] - place)]


def _due(until: int, step: int) -> int:
    """Milliseconds at which an entry goes; entries of about one time go together."""
    step = max(step, 1_000_000)
    return (until // step + 1) * step // 1000


class _Join:
    """Rows of both sides, of the keys of a bucket, that can still meet a partner: entries of a side and micro-batch, each of which
    goes once the watermark has passed all its rows and the waiting time.

    Rows and state come as whole columns, which costs far less a row than the calls of a ``StatefulProcessor``.
    """

    def __init__(self, wait_seconds: int, sides: tuple[list[str], list[str]]):
        self._wait = wait_seconds * 1_000_000
        self._sides = sides

    def _entries(self, own: bool, rows: pd.DataFrame) -> Iterator[tuple]:
        for at in range(0, len(rows), HELD_ROWS):
            part = rows[at : at + HELD_ROWS]
            data = pa.RecordBatch.from_pydict({c: pa.array(part[c], pa.int64() if c == "micros" else pa.string(), from_pandas=True) for c in part})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, data.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
                out.write_batch(data)
            yield own, int(part["micros"].max()) + self._wait, sink.getvalue().to_pybytes()

    def __call__(self, key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = pickle.loads(state.get[0]) if state.exists else []
        if state.hasTimedOut:
            limit = state.getCurrentWatermarkMs()
            held = [r for r in held if _due(r[1], self._wait) > limit]
        else:
            new = pd.concat(list(rows), ignore_index=True)
            left, right = (new.loc[new["own"] == own, ["who", "micros", *names]].reset_index(drop=True) for own, names in zip((True, False), self._sides))
            read = lambda own: (pa.ipc.open_stream(r[2]).read_pandas() for r in held if r[0] == own)
            met = itertools.chain(((left, r) for r in itertools.chain([right], read(False))), ((x, right) for x in read(True)))
            for one, two in met:
                for i, j in _pairs(one, two, self._wait):
                    columns = {"micros": one["micros"].to_numpy()[i]}
                    for names, side, at in zip(self._sides, (one, two), (i, j)):
                        columns |= {c: side[c].to_numpy()[at] for c in names}
                    yield pd.DataFrame(columns)
            held = [*held, *self._entries(True, left), *self._entries(False, right)]
        if held:
            state.update((pickle.dumps(held),))
            state.setTimeoutTimestamp(max(min(_due(r[1], self._wait) for r in held), state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()


def can_join_in_buckets(left: DataFrame, right: DataFrame, on: dict[str, str], ts: str) -> bool:
    """Whether texts of the keys are equal exactly where the keys are, and both times are instants."""
    plain = all(
        left.schema[a].dataType == right.schema[b].dataType and isinstance(left.schema[a].dataType, (StringType, IntegralType, DateType, BooleanType, TimestampType))
        for a, b in on.items()
    )
    return plain and all(isinstance(df.schema[ts].dataType, TimestampType) for df in (left, right))


def bounded_join_stream(left: DataFrame, right: DataFrame, on: dict[str, str], wait_seconds: int, ts: str) -> DataFrame:
    """Stream side of an inner ``joins.bounded_join`` that no other stateful operator follows: the time of its rows has no
    watermark. Texts travel as they are, the other columns as one JSON text."""
    kept = [[c for c in left.columns if c != ts], [c for c in right.columns if c != ts and c not in on.values()]]
    packed: list[dict[str, Column]] = []
    for df, names, mark in zip((left, right), kept, "lr"):
        texts = [c for c in names if isinstance(df.schema[c].dataType, StringType)]
        rest = [c for c in names if c not in texts]
        columns = {f"{mark}{names.index(c)}": F.col(c) for c in texts}
        packed.append(columns | ({f"{mark}_rest": F.to_json(F.struct(*rest), _JSON)} if rest else {}))
    sides = []
    for k, (df, keys) in enumerate(((left, list(on)), (right, list(on.values())))):
        known = [F.col(c).isNotNull() for c in (*keys, ts)]
        one_text = len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, StringType)
        who = F.col(keys[0]) if one_text else F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)]), _JSON)
        empty = F.lit(None).cast("string")
        sides.append(
            df.where(reduce(and_, known)).select(
                F.pmod(F.xxhash64(who), F.lit(BUCKETS)).cast("int").alias("bucket"),
                who.alias("who"),
                F.col(ts).alias("at"),
                F.unix_micros(ts).alias("micros"),
                F.lit(k == 0).alias("own"),
                *[(c if own == k else empty).alias(n) for own, columns in enumerate(packed) for n, c in columns.items()],
            )
        )
    names = [list(columns) for columns in packed]
    schema = ", ".join(["micros long", *(f"{n} string" for n in names[0] + names[1])])
    held = _Join(wait_seconds, (names[0], names[1]))

    def join(key, rows, state):
        return held(key, rows, state)

    rows = sides[0].unionByName(sides[1]).groupBy("bucket").applyInPandasWithState(join, schema, "held binary", "append", GroupStateTimeout.EventTimeTimeout)
    out = {ts: F.timestamp_micros("micros").alias(ts)}
    for df, own, mark in zip((left, right), kept, "lr"):
        body = StructType([df.schema[c] for c in own if not isinstance(df.schema[c].dataType, StringType)])
        if body.fields:
            rows = rows.withColumn(f"{mark}_rest", F.from_json(f"{mark}_rest", body, _JSON))
        out |= {(mark, c): (F.col(f"{mark}_rest")[c] if c in body.names else F.col(f"{mark}{own.index(c)}")).alias(c) for c in own}
    return rows.select(*[out[ts] if c == ts else out["l", c] for c in left.columns], *[out["r", c] for c in kept[1]])

"""Keyed stateful processors for ``transformWithState``.

A processor sees the rows of one key of one micro-batch, as plain rows of the columns it
names in ``reads``: a key costs its rows and a few state calls, and no data frame.  Rows
are put in ``(ts, event_id)`` order first, those without a time last; the source's slices bound
a micro-batch and with it what a key can bring at once, while the state kept between batches
is a few fixed-size values unless the docstring says otherwise.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.exact import units


def _column(df: DataFrame, name: str):
    """A column of the rows, or one that processors share: microseconds of ``ts``, cents of ``value``."""
    if name == "at" and name not in df.columns:
        return F.unix_micros("ts").alias(name)
    if name == "cents" and name not in df.columns:
        return F.when(~F.isnan("value"), units("value")).alias(name)
    return F.col(name)


def apply(df: DataFrame, key: str, processor: StatefulProcessor, schema: str, time: str = "None") -> DataFrame:
    """Run a processor per key in append mode; rows without a key are a key of their own.

    The worker takes rows of a missing key for one group each, so the key is made
    whole and a flag tells whether it was missing.  Only the columns that the processor
    reads are shuffled, last in a row; ``ts`` stays for the watermark.
    """
    whole = F.coalesce(F.col(key), F.lit(0).cast(df.schema[key].dataType)).alias(key)
    clock = [F.col("ts")] if "ts" in df.columns else []
    read = [_column(df, c) for c in processor.reads]
    flagged = df.select(whole, F.col(key).isNull().alias("__no_key"), *clock, *read)
    return flagged.groupBy(key, "__no_key").transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode=time
    )


def key_of(key: tuple):
    """The key as the rows had it."""
    return None if key[1] else key[0]


def row_of(schema: str) -> Row:
    """A maker of rows of this schema."""
    return Row(*(c.split()[0] for c in schema.split(", ")))


def _place(row: tuple) -> tuple:
    at, ident = row[0], row[1]
    return (at is None, at or 0, ident is None, ident or 0)


def in_order(rows: Iterable[Row], reads: tuple) -> list[tuple]:
    """What the processor reads of each row, ``at`` and ``event_id`` first, in their order."""
    width = len(reads)
    return sorted((r[-width:] for r in rows), key=_place)


def put_all(state, values: list[tuple]) -> None:
    """A list state with just these values; an empty one is cleared."""
    if values:
        state.put(values)
    else:
        state.clear()


def micros(ts: pd.Series) -> pd.Series:
    """Microseconds; a missing time stays missing."""
    return ts.astype("datetime64[us]").astype("int64").astype("Int64").where(ts.notna())


def grown(total: int | None, amount: int | None) -> int | None:
    """Sum so far, missing values skipped; missing until there is a first value."""
    if amount is None:
        return total
    return amount if total is None else total + amount


class RunningSum(StatefulProcessor):
    """Updated total for every row; state: one number, optionally with a TTL.

    Reading refreshes the TTL too, because the total is written back each time.
    """

    schema = "event_id BIGINT, user_id BIGINT, running_cents BIGINT"
    reads = ("at", "event_id", "cents")

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total BIGINT", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        row, user = row_of(self.schema), key_of(key)
        (total,) = self.total.get() or (None,)
        out = []
        for _, ident, cents in in_order(rows, self.reads):
            total = grown(total, cents)
            out.append(row(ident, user, total))
        self.total.update((total,))
        return iter(out)

    def close(self) -> None:
        pass


class CountedSum(StatefulProcessor):
    """The running sum after an upgrade: its state has gained a row count.

    State written by ``RunningSum`` is read with the new field empty.
    """

    schema = RunningSum.schema
    reads = RunningSum.reads

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total BIGINT, n BIGINT")

    def handleInputRows(self, key, rows, timerValues):
        row, user = row_of(self.schema), key_of(key)
        total, n = self.total.get() or (None, 0)
        out = []
        for _, ident, cents in in_order(rows, self.reads):
            total = grown(total, cents)
            out.append(row(ident, user, total))
        self.total.update((total, (n or 0) + len(out)))
        return iter(out)

    def close(self) -> None:
        pass


class EventTimeTtlSum(StatefulProcessor):
    """Running sum whose state expires once ``last_access + ttl <= now`` in event time."""

    schema = "event_id BIGINT, user_id BIGINT, running_cents BIGINT"
    reads = ("at", "event_id", "cents")

    def __init__(self, ttl_micros: int):
        self.ttl = ttl_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("s", "total BIGINT, last BIGINT")

    def handleInputRows(self, key, rows, timerValues):
        row, user = row_of(self.schema), key_of(key)
        total, last = self.state.get() or (None, None)
        out = []
        for at, ident, cents in in_order(rows, self.reads):
            if at is not None and last is not None and at - last >= self.ttl:
                total = None
            total, last = grown(total, cents), at
            out.append(row(ident, user, total))
        self.state.update((total, last))
        return iter(out)

    def close(self) -> None:
        pass


class CountTrigger(StatefulProcessor):
    """Global window with a count trigger: fire at every ``n``-th row of a key.

    Purging clears the sum when it fires (tumbling count windows); without it
    the sum keeps growing from firing to firing.
    """

    schema = "user_id BIGINT, window_no BIGINT, cents BIGINT, first_event BIGINT"
    reads = ("at", "event_id", "cents")

    def __init__(self, n: int, purge: bool):
        self.n, self.purge = n, purge

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("w", "seen BIGINT, cents BIGINT, first BIGINT")

    def handleInputRows(self, key, rows, timerValues):
        row, user = row_of(self.schema), key_of(key)
        seen, held, first = self.state.get() or (0, 0, None)
        out = []
        for _, ident, cents in in_order(rows, self.reads):
            if seen == 0 or self.purge and seen % self.n == 0:
                first = ident
            held, seen = held + (cents or 0), seen + 1
            if seen % self.n == 0:
                out.append(row(user, seen // self.n - 1, held, first))
                if self.purge:
                    held, first = 0, None
        self.state.update((seen, held, first))
        return iter(out)

    def close(self) -> None:
        pass


class Previous(StatefulProcessor):
    """Process function: each row with its predecessor; state: the last row seen."""

    schema = (
        "event_id BIGINT, user_id BIGINT, event_type STRING, previous_state STRING, "
        "previous_id BIGINT, waited_us BIGINT"
    )
    reads = ("at", "event_id", "event_type")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "kind STRING, id BIGINT, at BIGINT")

    def handleInputRows(self, key, rows, timerValues):
        row, user = row_of(self.schema), key_of(key)
        before, before_id, before_at = self.last.get() or (None, None, None)
        out = []
        for at, ident, kind in in_order(rows, self.reads):
            waited = None if at is None or before_at is None else at - before_at
            out.append(row(ident, user, kind, before, before_id, waited))
            before, before_id, before_at = kind, ident, at
        self.last.update((before, before_id, before_at))
        return iter(out)

    def close(self) -> None:
        pass


class Silence(StatefulProcessor):
    """Event-time timers: report a key's last row once it stayed silent too long.

    Every row moves the timer.  Rows already further apart than the limit are
    reported at once, as a timer that is already past fires at once.
    """

    schema = "user_id BIGINT, event_id BIGINT"
    reads = ("at", "event_id")

    def __init__(self, limit_ms: int):
        self.limit = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "id BIGINT, at BIGINT, reported BOOLEAN")

    def handleInputRows(self, key, rows, timerValues):
        turns = [(ident, None if at is None else at // 1000) for at, ident in in_order(rows, self.reads)]
        held = self.last.get()
        if held is not None:
            ident, when, reported = held
            if not reported:
                if when is not None:
                    self.handle.deleteTimer(when + self.limit)
                turns = [(ident, when), *turns]
        silent = [i for (i, a), (_, b) in zip(turns, turns[1:]) if a is None or b is None or b - a > self.limit]
        ident, when = turns[-1]
        self.last.update((ident, when, when is None))
        if when is None:  # without a time there is nothing to wait for
            silent.append(ident)
        else:
            self.handle.registerTimer(when + self.limit)
        row, user = row_of(self.schema), key_of(key)
        return iter([row(user, i) for i in silent])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        ident, when, _ = self.last.get()
        self.last.update((ident, when, True))
        return iter([row_of(self.schema)(key_of(key), ident)])

    def close(self) -> None:
        pass


class ErrorsBetween(StatefulProcessor):
    """Two inputs sharing keyed state: errors (side 0) counted until a purchase (side 1)."""

    schema = "event_id BIGINT, user_id BIGINT, errors_before BIGINT"
    reads = ("at", "event_id", "side")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "n BIGINT")

    def handleInputRows(self, key, rows, timerValues):
        row, user = row_of(self.schema), key_of(key)
        (errors,) = self.open.get() or (0,)
        out = []
        for _, ident, side in in_order(rows, self.reads):
            if side == 1:
                out.append(row(ident, user, errors))
                errors = 0
            else:
                errors += 1
        self.open.update((errors,))
        return iter(out)

    def close(self) -> None:
        pass


class StrictSequence(StatefulProcessor):
    """Adjacent rows of a key whose types are ``kinds`` in turn, within a time limit.

    State: the last ``len(kinds) - 1`` rows.
    """

    schema = "user_id BIGINT, event_id_1 BIGINT, event_id_2 BIGINT, event_id_3 BIGINT"
    reads = ("at", "event_id", "event_type")

    def __init__(self, kinds: list[str], within_micros: int):
        self.kinds, self.within = kinds, within_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tail = handle.getListState("tail", "kind STRING, id BIGINT, at BIGINT")

    def handleInputRows(self, key, rows, timerValues):
        row, user, n = row_of(self.schema), key_of(key), len(self.kinds)
        seen = [*self.tail.get(), *((kind, ident, at) for at, ident, kind in in_order(rows, self.reads))]
        out = []
        for end in range(n, len(seen) + 1):
            run = seen[end - n : end]
            if [kind for kind, _, _ in run] == self.kinds:
                first, last = run[0][2], run[-1][2]
                if first is not None and last is not None and last - first <= self.within:
                    out.append(row(user, *(ident for _, ident, _ in run)))
        self.tail.put(seen[-(n - 1) :])
        return iter(out)

    def close(self) -> None:
        pass


class KeepFirst(StatefulProcessor):
    """First row per key and event type; state: the types already seen."""

    schema = "event_id BIGINT, user_id BIGINT, event_type STRING"
    reads = ("at", "event_id", "event_type")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "known BOOLEAN, kind STRING", "id BIGINT")

    def handleInputRows(self, key, rows, timerValues):
        row, user = row_of(self.schema), key_of(key)
        firsts = {}
        for _, ident, kind in in_order(rows, self.reads):
            firsts.setdefault(kind, ident)
        out = []
        for kind, ident in firsts.items():
            place = (kind is not None, kind or "")
            if not self.seen.containsKey(place):
                self.seen.updateValue(place, (ident,))
                out.append(row(ident, user, kind))
        return iter(out)

    def close(self) -> None:
        pass


class StateKinds(StatefulProcessor):
    """All kinds of keyed state at once; one row per key and batch.

    value: row count; list: the last three ids; map: count per type; reducing:
    largest value; aggregating: sum of cents.
    """

    schema = (
        "user_id BIGINT, n BIGINT, last_ids STRING, counts STRING, top DOUBLE, cents BIGINT"
    )
    reads = ("at", "event_id", "event_type", "value", "cents")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.n = handle.getValueState("n", "n BIGINT")
        self.ids = handle.getListState("ids", "id BIGINT")
        self.counts = handle.getMapState("counts", "kind STRING", "n BIGINT")
        self.top = handle.getValueState("top", "top DOUBLE")
        self.cents = handle.getValueState("cents", "cents BIGINT")

    @staticmethod
    def _fold(state, value, fold):
        """Reducing and aggregating state: a value state plus a fold; None adds nothing."""
        (held,) = state.get() or (None,)
        merged = value if held is None else held if value is None else fold(held, value)
        if value is not None:
            state.update((merged,))
        return merged

    def handleInputRows(self, key, rows, timerValues):
        turns = in_order(rows, self.reads)
        n = self._fold(self.n, len(turns), lambda a, b: a + b)
        known = [r for r in turns if r[3] is not None and r[3] == r[3]]
        top = self._fold(self.top, max((float(r[3]) for r in known), default=None), max)
        total = self._fold(self.cents, sum(r[4] for r in known) if known else None, lambda a, b: a + b)
        ids = [*(r[0] for r in self.ids.get()), *(r[1] for r in turns)][-3:]
        self.ids.put([(i,) for i in ids])
        counts = {k[0]: v[0] for k, v in self.counts.iterator()}
        for kind, c in Counter(r[2] for r in turns if r[2] is not None).items():
            counts[kind] = counts.get(kind, 0) + c
            self.counts.updateValue((kind,), (counts[kind],))
        last = ",".join(str(i) for i in ids if i is not None)
        each = ",".join(f"{k}={c}" for k, c in sorted(counts.items()))
        return iter([row_of(self.schema)(key_of(key), n, last, each, top, total)])

    def close(self) -> None:
        pass


class BufferingSink(StatefulProcessor):
    """Non-keyed list state under a bucket key: rows are let go in full buffers.

    State: fewer than ``size`` ids per bucket; a timer empties it at the end.
    """

    schema = "event_id BIGINT, flushed_by STRING"
    reads = ("at", "event_id")

    def __init__(self, size: int, idle_ms: int):
        self.size, self.idle = size, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "id BIGINT")
        self.timer = handle.getValueState("timer", "at BIGINT")

    def handleInputRows(self, key, rows, timerValues):
        turns = in_order(rows, self.reads)
        times = [at for at, _ in turns if at is not None]
        latest = times[-1] // 1000 if times else timerValues.getCurrentWatermarkInMs()
        ids = [*(r[0] for r in self.held.get()), *(ident for _, ident in turns)]
        full = len(ids) // self.size * self.size
        rest = ids[full:]
        if rest:
            self.held.put([(i,) for i in rest])
        else:
            self.held.clear()
        timer = self.timer.get()
        if timer is not None:
            self.handle.deleteTimer(timer[0])
            self.timer.clear()
        if rest:
            self.handle.registerTimer(latest + self.idle)
            self.timer.update((latest + self.idle,))
        row = row_of(self.schema)
        return iter([row(i, "size") for i in ids[:full]])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        row = row_of(self.schema)
        rest = [row(r[0], "timer") for r in self.held.get()]
        self.held.clear()
        self.timer.clear()
        return iter(rest)

    def close(self) -> None:
        pass

"""Process functions: per row without a key, per key and window, and per window of all rows.

A window function is four mergeable steps (``create``, ``add``, ``merge``, ``result``)
over a small tuple.  ``add`` runs where rows are read, so only one tuple per window (and
key) and input batch is shuffled, however many rows a key or a window has.  The open
windows of a key are one value in the state, with one timer for the first to close.

All-window functions keep two levels of state.  The first holds partial windows under
``SALTS`` keys per window and passes them on when the watermark reaches the window's end;
the second merges at most ``SALTS`` partials per window.  No task holds a whole window.
Rows without a time belong to no window.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.exact import units
from millrace.streaming import processors as K

SALTS = 16
EPOCH = datetime(1970, 1, 1)


class TopAndTotal:
    """Rows, cents and the row of the largest value (of equals the smallest id) of a window."""

    result_schema = "n BIGINT, cents BIGINT, top_event BIGINT, first_event BIGINT"

    def create(self) -> tuple:
        return (0, 0, None, None)

    def add(self, held: tuple, at: int, event_id: int | None, value: float | None, cents: int | None) -> tuple:
        """With one more row, of this time in microseconds."""
        ident = (event_id is None, event_id)
        top = None if cents is None else (-value, *ident)
        return self.merge(held, (1, cents or 0, top, (at, *ident)))

    @staticmethod
    def _least(a: tuple | None, b: tuple | None) -> tuple | None:
        """The one that comes first: by value or time, then by id, a missing one last."""
        if a is None or b is None:
            return b if a is None else a
        return b if b[:2] < a[:2] or b[:2] == a[:2] and not b[1] and b[2] < a[2] else a

    def merge(self, a: tuple, b: tuple) -> tuple:
        return (a[0] + b[0], a[1] + b[1], self._least(a[2], b[2]), self._least(a[3], b[3]))

    def result(self, held: tuple) -> tuple:
        return (held[0], held[1], held[2] and held[2][2], held[3] and held[3][2])


class WindowState(StatefulProcessor):
    """The open windows of a grouping key in one value, a tuple by its end; a tuple leaves, merged or as a result, when its window is over."""

    def __init__(self, function, schema: str, last: bool):
        self.function, self.schema, self.last = function, schema, last

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "closes_ms ARRAY<BIGINT>, acc ARRAY<BINARY>")

    def _held(self) -> dict[int, bytes]:
        closes, accs = self.open.get() or ([], [])
        return {c: bytes(acc) for c, acc in zip(closes, accs)}

    def handleInputRows(self, key, rows, timerValues):
        held = self._held()
        timer, changed = min(held, default=None), {}
        for r in rows:
            closes, acc = r[-2:]
            if closes not in changed:
                changed[closes] = pickle.loads(held[closes]) if closes in held else self.function.create()
            changed[closes] = self.function.merge(changed[closes], pickle.loads(acc))
        held.update({closes: pickle.dumps(acc) for closes, acc in changed.items()})
        self.open.update((list(held), list(held.values())))
        following = min(held)
        if timer != following:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(following)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """All windows the watermark has passed leave together."""
        clock = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        row, out, rest = K.row_of(self.schema), [], {}
        for closes, acc in self._held().items():
            if closes > clock:
                rest[closes] = acc
            elif self.last:
                out.append(row(*key, closes, *self.function.result(pickle.loads(acc))))
            else:
                out.append(row(*key, closes, EPOCH + timedelta(milliseconds=closes - 1), acc))
        if rest:
            self.open.update((list(rest), list(rest.values())))
            self.handle.registerTimer(min(rest))
        else:
            self.open.clear()
        return iter(out)

    def close(self) -> None:
        pass


def _partials(events: DataFrame, key: Column, function, window_ms: int) -> DataFrame:
    """(key, no_key, closes_ms, acc): one tuple per key and window of what a task reads at once."""
    millis = F.unix_millis("ts")
    closes = millis - F.pmod(millis, F.lit(window_ms)) + window_ms
    rows = events.select(
        F.coalesce(key, F.lit(0).cast("bigint")).alias("key"), key.isNull().alias("no_key"), closes.alias("closes_ms"),
        F.unix_micros("ts").alias("at"), "event_id", "value", F.when(~F.isnan("value"), units("value")).alias("cents"),
    ).where("at IS NOT NULL")
    keys = ["key", "no_key", "closes_ms"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            sums = {}
            for a, b, c, *row in zip(*(column.to_pylist() for column in part.columns)):
                held = sums[a, b, c] if (a, b, c) in sums else function.create()
                sums[a, b, c] = function.add(held, *row)
            if sums:
                columns = [pa.array(v, t) for v, t in zip(zip(*sums), (pa.int64(), pa.bool_(), pa.int64()))]
                accs = pa.array([pickle.dumps(acc) for acc in sums.values()], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, accs], [*keys, "acc"])

    return rows.mapInArrow(work, "key BIGINT, no_key BOOLEAN, closes_ms BIGINT, acc BINARY")


def _stateful(rows: DataFrame, keys: list[str], schema: str, function, last: bool, event_time: str = "") -> DataFrame:
    """``rows`` end with closes_ms and acc; ``schema`` starts with the keys."""
    return rows.groupBy(*keys).transformWithState(
        statefulProcessor=WindowState(function, schema, last),
        outputStructType=schema,
        outputMode="append",
        timeMode="EventTime",
        eventTimeColumnName=event_time,
    )


def process_windows(events: DataFrame, key: str, function, window_ms: int) -> DataFrame:
    """The function's result per key and tumbling window: key, no_key, closes_ms and its columns."""
    schema = f"key BIGINT, no_key BOOLEAN, closes_ms BIGINT, {function.result_schema}"
    return _stateful(_partials(events, F.col(key), function, window_ms), ["key", "no_key"], schema, function, True)


def process_all_windows(events: DataFrame, function, window_ms: int) -> DataFrame:
    """The function's result per tumbling window of all rows: closes_ms and its columns."""
    salt = F.pmod(F.xxhash64("event_id"), F.lit(SALTS))
    parts = _partials(events, salt, function, window_ms).select(F.col("key").alias("salt"), "closes_ms", "acc")
    schema = "salt BIGINT, closes_ms BIGINT, closes TIMESTAMP, acc BINARY"
    level = _stateful(parts, ["salt"], schema, function, False, "closes")
    merged = level.select(F.col("closes_ms").alias("window"), "closes", "closes_ms", "acc")
    schema = f"window BIGINT, closes_ms BIGINT, {function.result_schema}"
    return _stateful(merged, ["window"], schema, function, True).drop("window")


def process_rows(stream: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A process function without key, state or shuffle: any number of rows out for the rows of a batch."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield function(part)

    return stream.mapInPandas(work, schema)

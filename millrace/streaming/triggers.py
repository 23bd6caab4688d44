"""Window triggers on keyed streams: when a window reports, and whether it then forgets.

Rows are first summed per (key, pane) where they are read, so a key with most of the
rows costs one small row per pane and input batch.  The keyed state is one value per key, the
accumulators of its open panes, read and written once per batch, and one timer, for its
next report; nothing holds a key's rows.

* ``event_time``: one report when the watermark passes the window's end.
* ``continuous``: a report at every pane border from the first row on, up to the end.
* ``never``: no report; the accumulators stay in the state store.

Firing and purging are apart: a report leaves the panes as they are, unless ``purge`` is
set; the end of a window always drops them.  A report at time b holds the rows before b,
whenever the timer is served, so reports do not depend on how rows fall into batches.
Rows without a time belong to no window.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.exact import units
from millrace.streaming import processors as K

KINDS = ("event_time", "continuous", "never")
OPEN = ", ".join(f"{c} ARRAY<BIGINT>" for c in ("pane", "n", "cents", "window", "at"))


def pane_rows(events: DataFrame, pane_ms: int | None) -> DataFrame:
    """(user_id, pane, cents) per row; ``pane`` is a start in milliseconds, 0 for the global window."""
    if pane_ms is None:
        pane = F.lit(0).cast("bigint")
    else:
        millis = F.unix_millis("ts")
        pane = millis - F.pmod(millis, F.lit(pane_ms))
    return events.select("user_id", pane.alias("pane"), units("value").alias("cents")).where("pane IS NOT NULL")


def _sum_panes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield (
            rows.assign(rows=1).groupby(["user_id", "pane"], dropna=False)
            .agg(n=("rows", "sum"), cents=("cents", "sum")).reset_index().astype({"user_id": "Int64"})
        )


def summed_panes(events: DataFrame, pane_ms: int | None) -> DataFrame:
    """(user_id, pane, n, cents): sums of what one task reads at once, before any shuffle."""
    return pane_rows(events, pane_ms).mapInPandas(_sum_panes, "user_id BIGINT, pane BIGINT, n BIGINT, cents BIGINT")


class PaneTrigger(StatefulProcessor):
    """Accumulators per pane of a key, and the next report of each open window."""

    schema = "user_id BIGINT, window_ms BIGINT, fired_ms BIGINT, n BIGINT, cents BIGINT"
    reads = ("pane", "n", "cents")

    def __init__(self, kind: str, window_ms: int, pane_ms: int, purge: bool = False):
        if kind not in KINDS or window_ms % pane_ms:
            raise ValueError("a trigger has a known kind and a window of whole panes")
        self.kind, self.window, self.pane, self.purge = kind, window_ms, pane_ms, purge

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def _held(self) -> tuple[dict, dict]:
        """Accumulators by pane, and the next report by window."""
        pane, n, cents, window, at = self.open.get() or ([],) * 5
        return dict(zip(pane, zip(n, cents))), dict(zip(window, at))

    def _keep(self, panes: dict, waiting: dict) -> None:
        if panes or waiting:
            sums = list(panes.values())
            held = (list(panes), [n for n, _ in sums], [c for _, c in sums], list(waiting), list(waiting.values()))
            self.open.update(held)
        else:
            self.open.clear()

    def handleInputRows(self, key, rows, timerValues):
        panes, waiting = self._held()
        fresh, timer = set(), min(waiting.values(), default=None)
        for r in rows:
            pane, n, cents = r[-3:]
            held = panes.get(pane, (0, 0))
            panes[pane] = (held[0] + n, held[1] + (cents or 0))
            fresh.add(pane)
        for pane in fresh if self.kind != "never" else ():
            window = pane - pane % self.window
            at = window + self.window if self.kind == "event_time" else pane + self.pane
            # An earlier pane may come to light: the window reports from there on.
            waiting[window] = min(at, waiting.get(window, at))
        self._keep(panes, waiting)
        following = min(waiting.values(), default=None)
        if timer != following:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(following)
        return iter(())

    def _reports(self, window: int, at: int, clock: int, panes: dict) -> tuple[list[tuple], int | None]:
        """Reports of a window from ``at`` on that the clock has passed, and its next border if it is open."""
        end, out = window + self.window, []
        while True:
            held = [panes[p] for p in range(window, at, self.pane) if p in panes]
            if held:
                out.append((window, at, sum(n for n, _ in held), sum(c for _, c in held)))
            if self.purge or at == end:
                for p in range(window, at, self.pane):
                    panes.pop(p, None)
            if at == end:
                return out, None
            at += self.pane
            if at > clock:
                return out, at

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """All borders the watermark has passed report in turn: a new timer waits for the next batch."""
        clock = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        panes, waiting = self._held()
        row, user, out, rest = K.row_of(self.schema), K.key_of(key), [], {}
        for window, at in waiting.items():
            if at <= clock:
                reports, at = self._reports(window, at, clock, panes)
                out += [row(user, *r) for r in reports]
            if at is not None:
                rest[window] = at
        self._keep(panes, rest)
        if rest:
            self.handle.registerTimer(min(rest.values()))
        return iter(out)

    def close(self) -> None:
        pass


def triggered(events: DataFrame, kind: str, window_ms: int, pane_ms: int, purge: bool = False) -> DataFrame:
    """Reports of the tumbling windows of each user (a stream with a watermark on ``ts``)."""
    trigger = PaneTrigger(kind, window_ms, pane_ms, purge)
    fired = K.apply(summed_panes(events, pane_ms), "user_id", trigger, trigger.schema, "EventTime")
    times = [F.timestamp_millis(f"{c}_ms").alias(name) for c, name in (("window", "window_start"), ("fired", "fired_at"))]
    return fired.select("user_id", *times, "n", "cents")


def held_accumulators(spark, checkpoint: str) -> DataFrame:
    """(user_id, pane, n, cents) that triggers left in the state store of a finished run."""
    state = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint)
    each = state.select("key", F.explode(F.arrays_zip("value.pane", "value.n", "value.cents")).alias("held"))
    user = F.when(~F.col("key.__no_key"), F.col("key.user_id")).alias("user_id")
    return each.select(user, F.col("held.pane").alias("pane"), F.col("held.n").alias("n"), F.col("held.cents").alias("cents"))

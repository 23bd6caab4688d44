"""Followed-by patterns on a stream, with time limit, timeouts and a comparator.

Rows wait in the state until the watermark has passed them and are then taken in
(time, comparator, id) order, so neither disorder within the watermark's delay nor the
cut into batches changes a match.  A partial match is one row: its start, the stage it
waits for and a node of the match buffer.  Nodes form chains shared by all partial
matches that took the same events: an event that many partial matches take is one node
per chain it extends.  Event-time timers drop partial matches that can no longer finish,
and nodes that no partial match leads to go with them.

Each start takes the first later match of each further condition, as
``operators.patterns.followed_by`` does on tables; a start that does not finish within the
limit (inclusive) is reported with ``matched`` false.  Rows without a time take no part.
State of a key: the rows behind the watermark's delay and the starts of one time limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming import processors as K

NO_NODE = -1
# The waiting rows, partial matches and nodes of a key, a column of each an array.
QUEUE, PARTIAL, NODES = ("seen", "at", "tie", "id", "flags"), ("stage", "node", "start", "begun"), ("name", "event", "before")
HELD = ", ".join(f"{c} ARRAY<BIGINT>" for c in (*QUEUE, *PARTIAL, *NODES)) + ", wake BIGINT"


def _columns(rows: list[tuple], names: tuple) -> list[list]:
    return [list(c) for c in zip(*rows)] if rows else [[] for _ in names]


class FollowedBy(StatefulProcessor):
    reads = ("seen", "at", "tie", "event_id", "flags")

    def __init__(self, stages: int, within_micros: int, rough_micros: int = 0):
        self.stages, self.within, self.rough = stages, within_micros, rough_micros
        self.schema = "user_id BIGINT, " + "".join(f"event_id_{i + 1} BIGINT, " for i in range(stages)) + "matched BOOLEAN"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", HELD)

    def _held(self) -> tuple[list, list, list, int | None]:
        """Rows, partial matches and nodes of the key, and its timer."""
        held = self.held.get()
        if held is None:
            return [], [], [], None
        q, p = len(QUEUE), len(QUEUE) + len(PARTIAL)
        return list(zip(*held[:q])), list(zip(*held[q:p])), list(zip(*held[p:-1])), held[-1]

    def _hold(self, queue: list, partial: list, nodes: list, wake: int) -> None:
        self.held.update((*_columns(queue, QUEUE), *_columns(partial, PARTIAL), *_columns(nodes, NODES), wake))

    def handleInputRows(self, key, rows, timerValues):
        width = len(self.reads)
        taken = [row for row in (r[-width:] for r in rows) if row[0] is not None and row[4] > 0]
        if taken:
            queue, partial, nodes, wake = self._held()
            at = min(row[0] for row in taken) // 1000 + 1
            if wake is None or at < wake:
                if wake is not None:
                    self.handle.deleteTimer(wake)
                self.handle.registerTimer(at)
                wake = at
            self._hold(queue + taken, partial, nodes, wake)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        clock = timerValues.getCurrentWatermarkInMs() * 1000
        queue, partial, known, _ = self._held()
        # A row is in its place once nothing of its pattern time can still come.
        edge = min((r[1] for r in queue if r[0] > clock), default=clock + 1)
        edge = min(edge, clock + 1 - self.rough)
        ready = sorted((r for r in queue if r[1] < edge), key=lambda r: tuple((x is None, x or 0) for x in r[1:4]))
        later = [r for r in queue if r[1] >= edge]
        nodes = {node: (event, before) for node, event, before in known}
        partial, out = self._advance(ready, partial, nodes)
        alive = []
        for p in partial:
            if p[3] + self.within < edge:
                out.append((p[2], *[None] * (self.stages - 1), False))
            else:
                alive.append(p)
        waits = [r[1] + self.rough for r in later] + [p[3] + self.within + self.rough for p in alive]
        if waits:
            wake = min(waits) // 1000 + 1
            self.handle.registerTimer(wake)
            self._hold(later, alive, self._used(alive, nodes), wake)
        else:
            self.held.clear()
        row, user = K.row_of(self.schema), K.key_of(key)
        return iter([row(user, *found) for found in out])

    def _advance(self, ready: list, partial: list, nodes: dict) -> tuple[list, list]:
        """Take rows in order; the partial matches left and the finished ones."""
        waiting: dict[int, list] = {}
        for p in partial:
            waiting.setdefault(p[0], []).append(p)
        fresh, out = max(nodes, default=NO_NODE) + 1, []
        for _, at, _, ident, flags in ready:
            for stage in range(self.stages - 1, 0, -1):  # the last first: a row moves a match once
                if not flags >> stage & 1 or stage not in waiting:
                    continue
                grown: dict[int, int] = {}
                for _, node, start, begun in waiting.pop(stage):
                    if stage == self.stages - 1:
                        ok = at - begun <= self.within
                        path = [*self._path(node, nodes), ident] if ok else [None] * (self.stages - 1)
                        out.append((start, *path, ok))
                        continue
                    if node not in grown:
                        grown[node], nodes[fresh] = fresh, (ident, node)
                        fresh += 1
                    waiting.setdefault(stage + 1, []).append((stage + 1, grown[node], start, begun))
            if flags & 1:
                waiting.setdefault(1, []).append((1, NO_NODE, ident, at))
        return [p for ps in waiting.values() for p in ps], out

    @staticmethod
    def _path(node: int, nodes: dict) -> list:
        path = []
        while node != NO_NODE:
            event, node = nodes[node]
            path.append(event)
        return path[::-1]

    @staticmethod
    def _used(alive: list, nodes: dict) -> list[tuple]:
        """The nodes that a partial match leads to."""
        used = set()
        for p in alive:
            node = p[1]
            while node != NO_NODE and node not in used:
                used.add(node)
                node = nodes[node][1]
        return [(node, *nodes[node]) for node in used]

    def close(self) -> None:
        pass


def followed_by(
    stream: DataFrame,
    conditions: Sequence[Column],
    within_seconds: int,
    comparator: Column | None = None,
    time: Column | None = None,
    rough_seconds: int = 0,
) -> DataFrame:
    """Matches and timed-out starts per user.

    ``comparator`` (a BIGINT, missing last) orders rows of one time, then the id.  ``time``
    stands for ``ts`` in the pattern: at most ``rough_seconds`` earlier, and not later.
    """
    flags = F.lit(0).cast("bigint")
    for i, c in enumerate(conditions):
        flags += F.when(c, 1 << i).otherwise(0)
    tie = F.lit(0) if comparator is None else comparator
    at = F.unix_micros(F.col("ts") if time is None else time)
    seen = F.unix_micros("ts").alias("seen")
    rows = stream.select("user_id", "ts", seen, "event_id", at.alias("at"), tie.cast("bigint").alias("tie"), flags.alias("flags"))
    processor = FollowedBy(len(conditions), within_seconds * 1_000_000, rough_seconds * 1_000_000)
    # The test names the time, so that it stays above the watermark and the clock sees every row.
    taken = rows.where("flags > 0 OR ts < TIMESTAMP '0001-01-01 00:00:00'")
    return K.apply(taken, "user_id", processor, processor.schema, "EventTime")

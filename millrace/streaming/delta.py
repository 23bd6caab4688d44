"""Windows cut by data in a stream: the largest value of each window that has ended.

The same windows as ``operators.delta_windows``: a key's window ends with the first row whose
distance (sum of absolute values so far) is more than ``delta`` beyond the last cut.  State
is six numbers per key, however long a window stays open.  Rows without a time take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming import processors as K


def _rank(best: tuple) -> tuple:
    return (best[0], best[1] is None, best[1] or 0)


def better(a: tuple | None, b: tuple | None) -> tuple | None:
    """The larger value; of equals the smaller id, a missing one last.  Tuples are (minus value, id)."""
    return min((x for x in (a, b) if x is not None), key=_rank, default=None)


class MaxPerDeltaWindow(StatefulProcessor):
    """One row for each window that ends; the open window stays in the state."""

    schema = "user_id BIGINT, window_no BIGINT, n BIGINT, top_cents BIGINT, top_event BIGINT"
    reads = ("at", "event_id", "cents")

    def __init__(self, delta: int):
        self.delta = delta

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "dist BIGINT, base BIGINT, no BIGINT, n BIGINT, low BIGINT, top BIGINT")

    def handleInputRows(self, key, rows, timerValues):
        row, user = K.row_of(self.schema), K.key_of(key)
        dist, base, no, n, low, top = self.open.get() or (0, None, 0, 0, None, None)
        best, out = None if low is None else (low, top), []
        for _, ident, cents in K.in_order(rows, self.reads):
            dist, n = dist + abs(cents or 0), n + 1
            base = dist if base is None else base
            if cents is not None:
                best = better(best, (-cents, ident))
            if dist - base > self.delta:
                out.append(row(user, no, n, best and -best[0], best and best[1]))
                base, no, n, best = dist, no + 1, 0, None
        self.open.update((dist, base, no, n, best and best[0], best and best[1]))
        return iter(out)

    def close(self) -> None:
        pass


def max_per_delta_window(events: DataFrame, key: str, delta: int) -> DataFrame:
    """user_id, window_no, n, top_cents, top_event of every window of ``key`` that has ended."""
    processor = MaxPerDeltaWindow(delta)
    return K.apply(events.where("ts IS NOT NULL"), key, processor, processor.schema)

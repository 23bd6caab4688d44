"""Timers and windows on the machine's clock.

All rows of a micro-batch share one machine time, so a batch is summed per key where it
is read and a key costs one small row per task and batch.  Processors take their clock
from the trigger, report what a timer closed, and also report every arrival they counted:
a window can so be checked from its own bounds.

A run over a bounded source reads all of it and then goes on with empty batches, which
serve the timers, until one has started after the last possible timer.  State, timers and
the sink's commit log are in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.exact import units
from millrace.scratch import new_folder
from millrace.streaming import processors as K
from millrace.streaming.runner import stream_settings

POLL_SECONDS = 0.2


def _sum_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield (
            rows.assign(n=1).groupby("user_id", dropna=False)
            .agg(n=("n", "sum"), cents=("cents", "sum")).reset_index().astype({"user_id": "Int64"})
        )


def summed_arrivals(events: DataFrame) -> DataFrame:
    """(user_id, n, cents): sums of what one task reads at once, before any shuffle."""
    rows = events.select("user_id", F.coalesce(units("value"), F.lit(0)).alias("cents"))
    return rows.mapInPandas(_sum_batch, "user_id BIGINT, n BIGINT, cents BIGINT")


def _totals(rows: Iterator[Row]) -> tuple[int, int]:
    n = cents = 0
    for r in rows:
        n, cents = n + r[-2], cents + r[-1]
    return n, cents


class MachineSilence(StatefulProcessor):
    """Processing-time timers: report a key whenever it stayed silent for ``limit_ms``.

    Every arrival moves the key's timer: the old one is deleted and a new one registered.
    """

    schema = "user_id BIGINT, seen_ms BIGINT, fired_ms BIGINT, n BIGINT"
    reads = ("n", "cents")

    def __init__(self, limit_ms: int):
        self.limit = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "seen BIGINT, n BIGINT, armed BOOLEAN")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        n, _ = _totals(rows)
        held = self.last.get()
        if held is not None:
            seen, before, armed = held
            n += before
            if armed:
                self.handle.deleteTimer(seen + self.limit)
        self.handle.registerTimer(now + self.limit)
        self.last.update((now, n, True))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        seen, n, _ = self.last.get()
        self.last.update((seen, n, False))
        return iter([K.row_of(self.schema)(K.key_of(key), seen, timerValues.getCurrentProcessingTimeInMs(), n)])

    def close(self) -> None:
        pass


class MachineWindows(StatefulProcessor):
    """Tumbling, sliding and session windows of the machine's clock, and the arrivals they count.

    State: a list with one accumulator per open window, and one timer for the first end.  A
    window closes at its end, a session ``gap`` after its last arrival; an arrival at that
    very moment opens the next one.
    """

    schema = "user_id BIGINT, kind STRING, start_ms BIGINT, end_ms BIGINT, n BIGINT, cents BIGINT"
    reads = ("n", "cents")

    def __init__(self, size_ms: int, slide_ms: int, gap_ms: int):
        if size_ms % slide_ms:
            raise ValueError("a sliding window is a whole number of slides")
        self.size, self.slide, self.gap = size_ms, slide_ms, gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "kind STRING, start BIGINT, end BIGINT, n BIGINT, cents BIGINT")

    def _parted(self, key, now: int) -> tuple[list[Row], dict, int | None]:
        """Windows that end by ``now`` as rows, the open ones by kind and start, and the first end of all."""
        held = [tuple(w) for w in self.open.get()]
        row, user = K.row_of(self.schema), K.key_of(key)
        due = [row(user, *w) for w in sorted(held) if w[2] <= now]
        return due, {w[:2]: w[2:] for w in held if w[2] > now}, min((w[2] for w in held), default=None)

    def _keep(self, windows: dict) -> None:
        K.put_all(self.open, [(*name, *held) for name, held in windows.items()])

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        n, cents = _totals(rows)
        # A batch may start after an end and before the timer is served.
        out, windows, timer = self._parted(key, now)

        def add(kind: str, start: int, end: int) -> None:
            _, held_n, held_cents = windows.get((kind, start), (end, 0, 0))
            windows[kind, start] = (end, held_n + n, held_cents + cents)

        add("tumbling", now - now % self.size, now - now % self.size + self.size)
        last = now - now % self.slide
        for start in range(last - self.size + self.slide, last + 1, self.slide):
            add("sliding", start, start + self.size)
        add("session", next((start for kind, start in windows if kind == "session"), now), now + self.gap)
        self._keep(windows)
        following = min(end for end, _, _ in windows.values())
        if timer != following:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(following)
        return iter([*out, K.row_of(self.schema)(K.key_of(key), "arrival", now, now, n, cents)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        out, windows, _ = self._parted(key, timerValues.getCurrentProcessingTimeInMs())
        self._keep(windows)
        if windows:
            self.handle.registerTimer(min(end for end, _, _ in windows.values()))
        return iter(out)

    def close(self) -> None:
        pass


def _started_ms(progress) -> float:
    at = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
    return at.astimezone(timezone.utc).timestamp() * 1000


def run_machine_time(stream: DataFrame, label: str, longest_ms: int) -> DataFrame:
    """Run a processing-time stream over its bounded source until no timer can be left.

    ``longest_ms`` is the longest wait of a timer after the arrival that set it.  A source
    of files gives rows as long as it has any, so a trigger without rows starts after all
    arrivals, and one that starts ``longest_ms`` later has served every timer.
    """
    spark, base = stream.sparkSession, new_folder(stream.sparkSession, label)
    with stream_settings(spark):
        query = (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", f"{base}/checkpoint")
            .outputMode("append")
            .trigger(processingTime="500 milliseconds")
            .start(f"{base}/data")
        )
        try:
            empty_since = None
            while not query.awaitTermination(POLL_SECONDS):  # raises what ended the query
                p = query.lastProgress
                if p is None or p.numInputRows:
                    empty_since = None
                elif empty_since is None:
                    empty_since = _started_ms(p)
                elif _started_ms(p) >= empty_since + longest_ms:
                    break
        finally:
            query.stop()
    return spark.read.schema(stream.schema).parquet(f"{base}/data")


def recounted(reports: DataFrame, size_ms: int, slide_ms: int, gap_ms: int) -> DataFrame:
    """The windows that the reported arrivals imply, worked out as a batch from their times."""
    arrivals = reports.where("kind = 'arrival'").select("user_id", F.col("start_ms").alias("at"), "n", "cents")
    sums = [F.sum("n").alias("n"), F.sum("cents").alias("cents")]

    def fixed(kind: str, slide: int) -> DataFrame:
        last = F.col("at") - F.pmod(F.col("at"), F.lit(slide))
        starts = F.explode(F.sequence(last - F.lit(size_ms - slide), last, F.lit(slide)))
        return arrivals.withColumn("start_ms", starts).groupBy("user_id", "start_ms").agg(*sums).select(
            "user_id", F.lit(kind).alias("kind"), "start_ms", (F.col("start_ms") + size_ms).alias("end_ms"), "n", "cents"
        )

    # A key has one arrival per micro-batch, so its window partition is short.
    turn = Window.partitionBy("user_id").orderBy("at")
    new = F.coalesce(F.col("at") - F.lag("at").over(turn) >= gap_ms, F.lit(True)).cast("int")
    numbered = arrivals.withColumn("new", new).withColumn("no", F.sum("new").over(turn))
    sessions = numbered.groupBy("user_id", "no").agg(
        F.min("at").alias("start_ms"), (F.max("at") + gap_ms).alias("end_ms"), *sums
    ).select("user_id", F.lit("session").alias("kind"), "start_ms", "end_ms", "n", "cents")
    return fixed("tumbling", size_ms).unionByName(fixed("sliding", slide_ms)).unionByName(sessions)

"""Rules that change while a stream runs: each row meets the version valid at its own time.

Rules come as a changelog stream (kind, valid_from, floor in cents; a missing floor takes
the rule back).  Rows wait in keyed state until the watermark has passed them, so a rule
counts from its time on whether it arrives before or after the rows.  The key is (kind,
salt): rows of a hot kind spread over ``SALTS`` keys, and every rule goes to each of them.

State per key: the rows between the watermark and the newest time, and the versions that
can still matter, which are the newest one the watermark has passed and all later ones.
Rows without a kind, time or value meet no rule and are left out before the shuffle; a
version without a time is none.  Of two versions of one time the last one read counts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.exact import units
from millrace.streaming.processors import micros

SALTS = 8
RULE_SCHEMA = "kind STRING, ts TIMESTAMP, floor_cents BIGINT, is_end BOOLEAN"


def _block(columns) -> bytes:
    return np.stack([np.asarray(c, np.int64) for c in columns]).tobytes()


class VersionedRules(StatefulProcessor):
    """Rows above the floor of their rule's version, with the floor that decided."""

    schema = "event_id BIGINT, event_type STRING, floor_cents BIGINT, above BIGINT"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # A batch's rows are one block: ids, missing ids, times and cents, eight bytes each.
        self.rows = handle.getListState("rows", "block BINARY")
        self.versions = handle.getMapState("versions", "at BIGINT", "floor BIGINT")
        self.waiting = handle.getValueState("waiting", "ms BIGINT")

    def _wait(self, first: int) -> None:
        """One timer per key: just after its oldest row."""
        at = first // 1000 + 1
        if self.waiting.exists():
            known = self.waiting.get()[0]
            if known <= at:
                return
            self.handle.deleteTimer(known)
        self.handle.registerTimer(at)
        self.waiting.update((at,))

    def handleInputRows(self, key, rows, timerValues):
        for part in rows:
            part = part.assign(at=micros(part["ts"]))
            changes = part[part["is_rule"]]
            for at, floor in zip(changes["at"], changes["cents"]):
                self.versions.updateValue((int(at),), (None if pd.isna(floor) else int(floor),))
            plain = part[~part["is_rule"]]
            if len(plain):
                ids = plain["event_id"]
                self.rows.appendValue((_block([ids.fillna(0), ids.isna(), plain["at"], plain["cents"]]),))
                self._wait(int(plain["at"].min()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        self.waiting.clear()
        blocks = [np.frombuffer(bytes(b), np.int64).reshape(4, -1) for (b,) in self.rows.get()]
        held = np.concatenate(blocks, axis=1) if blocks else np.zeros((4, 0), np.int64)
        ready, rest = held[:, held[2] < passed], held[:, held[2] >= passed]
        if rest.shape[1]:
            self.rows.put([(_block(rest),)])
            self._wait(int(rest[2].min()))
        else:
            self.rows.clear()
        versions = sorted((k[0], v[0]) for k, v in self.versions.iterator())
        begins = np.array([at for at, _ in versions], np.int64)
        for at in begins[: max(int(np.searchsorted(begins, passed)) - 1, 0)]:
            self.versions.removeKey((int(at),))
        # Before the first version, and where a version takes the rule back, there is no floor.
        floors = pd.array([floor for _, floor in versions] + [None], "Int64")
        floor = floors[np.searchsorted(begins, ready[2], side="right") - 1]
        ids, missing, _, cents = ready
        out = pd.DataFrame({"event_id": pd.arrays.IntegerArray(ids.copy(), missing.astype(bool)), "event_type": key[0], "floor_cents": floor})
        out["above"] = cents - out["floor_cents"]
        out = out[(out["above"] > 0).fillna(False).astype(bool)]
        if len(out):
            yield out

    def close(self) -> None:
        pass


def _complete(*columns: str) -> Column:
    """None of the columns is missing.

    One expression over all of them, the time included: parts of a conjunction would be
    moved below the watermark, where the end row would be gone before the clock sees it.
    """
    return ~F.exists(F.array(*(F.col(c).isNull() for c in columns)), lambda missing: missing)


def ruled(events: DataFrame, rules: DataFrame, salts: int = SALTS) -> DataFrame:
    """Rows above their rule's floor; both inputs are streams with a watermark on ``ts``."""
    rows = events.where(_complete("ts", "event_type", "value")).select(
        F.col("event_type").alias("kind"),
        F.pmod(F.xxhash64("event_id"), F.lit(salts)).cast("int").alias("salt"),
        "ts",
        F.lit(False).alias("is_rule"),
        "event_id",
        units("value").alias("cents"),
    )
    changes = rules.where(_complete("ts", "kind")).select(
        "kind",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        "ts",
        F.lit(True).alias("is_rule"),
        F.lit(None).cast("bigint").alias("event_id"),
        F.col("floor_cents").alias("cents"),
    )
    processor = VersionedRules()
    return rows.unionByName(changes).groupBy("kind", "salt").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.schema, outputMode="append", timeMode="EventTime"
    )


def rule_stream(spark, folder: str, delay: str) -> DataFrame:
    """Rule versions from files, one file per micro-batch, the end row included in the clock."""
    stream = spark.readStream.schema(RULE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    return stream.withWatermark("ts", delay).where("NOT (is_end AND ts > TIMESTAMP '0001-01-01 00:00:00')")

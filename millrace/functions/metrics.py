"""Metrics that user code fills inside Python workers: counter, distribution and meter.

Each metric is a Spark accumulator whose value has a bounded size and merges in any order:

* ``Counter``: a sum.
* ``Distribution``: count, sum, least, largest and a histogram of whole numbers for
  quantiles.  A bucket keeps the leading ``DIGITS`` bits of a number, so a quantile is the
  bucket of the exact one, at most 1.6% below it; the histogram has at most 64 buckets for
  each power of two.
* ``Meter``: marks per second of the last minute that was marked, and the rate over it.

A task that is run again counts once when its stage is the last of the job, as in a write;
Spark drops the second report of such a task.  In a stage before a shuffle a lost executor
may count rows twice, so metrics belong to the step that writes.
"""

from __future__ import annotations

from collections import Counter as Tally
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import AccumulatorParam
from pyspark.sql import SparkSession

DIGITS = 7
METER_SECONDS = 60


def bucket(values: np.ndarray) -> np.ndarray:
    """Whole numbers with all but their leading ``DIGITS`` bits set to zero."""
    size = np.abs(values.astype(np.int64))
    bits = np.zeros(len(size), np.int64)
    rest = size.copy()
    for step in (32, 16, 8, 4, 2, 1):
        more = rest >> step > 0
        bits[more] += step
        rest[more] >>= step
    shift = np.maximum(bits + 1 - DIGITS, 0)
    return np.sign(values) * (size >> shift << shift)


@dataclass
class Counter:
    n: int = 0

    def merge(self, other: Counter) -> Counter:
        return Counter(self.n + other.n)


@dataclass
class Distribution:
    n: int = 0
    total: int = 0
    low: int | None = None
    high: int | None = None
    buckets: Tally = field(default_factory=Tally)

    @staticmethod
    def of(values: pd.Series) -> Distribution:
        """Of whole numbers; missing values are left out."""
        known = values.dropna().to_numpy(np.int64)
        if not len(known):
            return Distribution()
        at, held = np.unique(bucket(known), return_counts=True)
        tally = Tally(dict(zip(at.tolist(), held.tolist())))
        return Distribution(len(known), int(known.sum()), int(known.min()), int(known.max()), tally)

    def merge(self, other: Distribution) -> Distribution:
        lows = [x for x in (self.low, other.low) if x is not None]
        highs = [x for x in (self.high, other.high) if x is not None]
        return Distribution(
            self.n + other.n, self.total + other.total, min(lows, default=None), max(highs, default=None),
            self.buckets + other.buckets,
        )

    def quantile(self, percent: int) -> int | None:
        """The bucket of the least value that ``percent`` of all values do not pass."""
        left = -(-self.n * percent // 100)
        for at, held in sorted(self.buckets.items()):
            left -= held
            if left <= 0:
                return at
        return None


@dataclass
class Meter:
    marks: Tally = field(default_factory=Tally)  # by second

    @staticmethod
    def of(seconds: pd.Series) -> Meter:
        at, held = np.unique(seconds.dropna().to_numpy(np.int64), return_counts=True)
        return Meter(_last_minute(Tally(dict(zip(at.tolist(), held.tolist())))))

    def merge(self, other: Meter) -> Meter:
        return Meter(_last_minute(self.marks + other.marks))

    @property
    def per_minute(self) -> int:
        return sum(self.marks.values())


def _last_minute(marks: Tally) -> Tally:
    newest = max(marks, default=0)
    return Tally({at: n for at, n in marks.items() if at > newest - METER_SECONDS})


class _Merged(AccumulatorParam):
    """Accumulates any of the metrics above."""

    def zero(self, value):
        return type(value)()

    def addInPlace(self, value1, value2):
        return value1.merge(value2)


class UserMetrics:
    """Metrics by name: made on the driver, filled by user code, read on the driver."""

    def __init__(self, spark: SparkSession, **kinds: type):
        self._held = {name: spark.sparkContext.accumulator(kind(), _Merged()) for name, kind in kinds.items()}

    def add(self, name: str, value) -> None:
        self._held[name].add(value)

    def __getitem__(self, name: str):
        return self._held[name].value

"""Size checks that decide between a one-task or broadcast plan and a split one.

The estimates come from Catalyst's statistics (file sizes carried up the plan),
so a check costs no job.  Filters and projections keep or shrink the estimate
and joins multiply it: it errs towards "too large", where the exact split plan
is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ONE_TASK_BYTES = "spark.millrace.oneTaskBytes"
BROADCAST_BYTES = "spark.millrace.broadcastBytes"

_DEFAULTS = {ONE_TASK_BYTES: 64 * 1024 * 1024, BROADCAST_BYTES: 10 * 1024 * 1024}


def limit_bytes(spark: SparkSession, key: str) -> int:
    return int(spark.conf.get(key, str(_DEFAULTS[key])))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of ``df``."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def fits_one_task(df: DataFrame, share: int = 1) -> bool:
    """True when the whole input, hence any key of it, suits a single task.

    ``share`` lowers the bound to that part of it, for work that does go to one task.
    """
    return estimated_bytes(df) <= limit_bytes(df.sparkSession, ONE_TASK_BYTES) // share


def small_side(df: DataFrame) -> DataFrame:
    """Mark ``df`` for broadcast if its estimate is under the bound.

    Over the bound the frame is returned as it is and Spark joins it by shuffle
    with adaptive skew splitting, so the result does not depend on the size.
    """
    if estimated_bytes(df) <= limit_bytes(df.sparkSession, BROADCAST_BYTES):
        return F.broadcast(df)
    return df

"""Sinks: statement sets, discarding, guarded appends."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def discard(df: DataFrame) -> None:
    """Run the whole plan and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def statement_set(
    shared: DataFrame,
    inserts: Mapping[str, Callable[[DataFrame], DataFrame]],
    reuse: bool = False,
) -> None:
    """Several inserts fed by one input; ``inserts`` maps a target path to its query.

    Cheap inputs (a scan, a projection) are simply re-read with each sink's own
    pruned columns.  With ``reuse`` an expensive input is kept, spilling to
    disk, while the sinks are written.
    """
    source = shared.persist(StorageLevel.DISK_ONLY) if reuse else shared
    try:
        for path, build in inserts.items():
            build(source).write.mode("errorifexists").parquet(path)
    finally:
        if reuse:
            source.unpersist()

"""Session defaults for local runs; a cluster brings its own settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def local_session(cpus: int | None = None, app: str = "millrace") -> SparkSession:
    """A ``local[n]`` session with the settings the operators are tested under.

    The session zone is pinned to UTC so zone-less and zone-aware timestamps
    agree, and adaptive execution (coalescing, skew-join splitting) stays on.
    """
    n = cpus or os.cpu_count() or 4
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

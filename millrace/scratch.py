"""Where intermediate tables, streaming checkpoints and cut lineage live.

On a cluster that must be a folder every executor can reach, so the place is
read from ``spark.checkpoint.dir``.  Only a ``local[...]`` session may fall
back to a temporary folder of this machine.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_BASES: dict[str, str] = {}


def shared_base(spark: SparkSession) -> str:
    """The shared folder of this session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    sc = spark.sparkContext
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder all executors can reach"
        )
    if sc.applicationId not in _LOCAL_BASES:
        _LOCAL_BASES[sc.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    return _LOCAL_BASES[sc.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; it is not created here."""
    return f"{shared_base(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` through a reliable checkpoint and drop its lineage.

    The data goes to the shared folder, so a lost executor costs nothing.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_base(spark) + "/lineage")
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table under the shared folder and read it back.

    Like ``cut_lineage``, and size checks after it see the table's own size rather than
    an estimate multiplied over joins.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)

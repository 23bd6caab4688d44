"""The cut tables of delta windows take no broadcast."""

from pyspark.sql import functions as F

from millrace.operators import delta_windows as D


def test_tables_of_cuts_are_not_broadcast(spark, monkeypatch):
    """They have a row for most input rows, but are small as files."""
    plans, write = [], D.written

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(D, "written", seen)
    table = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"), F.lit(7).alias("v"))
    assert D.delta_windows(table, ["k"], ["t"], F.col("v"), 20).count() == 500
    assert sum("Join" in p for p in plans) > 3 and not any("Broadcast" in p for p in plans)

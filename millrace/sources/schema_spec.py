"""Declared table schemas: computed and metadata columns, watermark, key."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class TableSpec:
    """What a table declares on top of its physical columns.

    The primary key is a statement about the data, recorded and not enforced.
    """

    computed: dict[str, str] = field(default_factory=dict)
    metadata: dict[str, str] = field(default_factory=dict)
    watermark: tuple[str, str] | None = None
    primary_key: tuple[str, ...] = ()

    def column(self, name: str, expression: str) -> "TableSpec":
        self.computed[name] = expression
        return self

    def from_metadata(self, name: str, key: str) -> "TableSpec":
        self.metadata[name] = key
        return self

    def with_watermark(self, column: str, delay: str) -> "TableSpec":
        self.watermark = (column, delay)
        return self

    def key(self, *columns: str) -> "TableSpec":
        self.primary_key = columns
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        """Add the declared columns; a watermark needs a zone-aware time column."""
        out = df.withColumns(
            {n: F.col(f"_metadata.{k}") for n, k in self.metadata.items()}
        ) if self.metadata else df
        if self.computed:
            out = out.withColumns({n: F.expr(e) for n, e in self.computed.items()})
        if self.watermark:
            name, delay = self.watermark
            if out.schema[name].dataType.simpleString() == "timestamp_ntz":
                out = out.withColumn(name, F.col(name).cast("timestamp"))
            out = out.withWatermark(name, delay)
        return out

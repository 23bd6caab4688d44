"""Named queries: one per operator, each with a SQL statement of its result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.tables import Tables


@dataclass(frozen=True)
class Query:
    ident: str
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(ident: str, slug: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``<ident>_<slug>``.

    ``sql`` is the same result for an independent SQL engine over the same
    tables; it is left out only where SQL cannot state the result.
    """

    def wrap(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = f"{ident}_{slug}".lower().replace("-", "_")
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(ident, name, fn, sql)
        return fn

    return wrap

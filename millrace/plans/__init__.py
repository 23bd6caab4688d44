"""One registered query per operator of the inventory, by section."""

from millrace.plans.registry import REGISTRY, Query, query
from millrace.plans import (  # noqa: F401  (importing registers the queries)
    projections,
    ordering,
    set_operations,
    scalar_functions,
    joins,
    aggregations,
    over_windows,
    sources_sinks,
    user_functions,
    event_time,
    stream_jobs,
    stream_clock,
    stream_windows,
    stream_sinks,
    tpch,
)

__all__ = ["REGISTRY", "Query", "query"]

"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder and ``BENCH_CPUS`` the local cores.
Each query runs its whole plan into a discarding sink.
"""

from __future__ import annotations

import json
import os
import time

from millrace.plans import REGISTRY
from millrace.session import local_session
from millrace.sources.sinks import discard

HEADLINE = [
    *[f"tpch_q{i}" for i in range(1, 23)],
    "prj_19_word_count",
    "jon_09_self_join_inequality",
    "jon_10_pure_range",
    "jon_22_interval_join",
    "jon_23_window_join",
    "jon_24_as_of_join",
    "agg_03_count_distinct",
    "agg_11_rollup",
    "agg_21_reduce_groups",
    "agg_28_running_keyed_sum",
    "win_01_dedup_keep_last",
    "win_02_top_n_per_group",
    "win_06_cumulative_frames",
    "win_10_count_window_sliding",
    "set_04_intersect_all",
    "snk_13_full_changelog",
    "str_02_tumbling_window",
    "str_04_sliding_window",
    "str_05_session_window",
    "str_22_followed_by_pattern",
    "str_02_tumbling_window_stream",
    "agg_28_running_keyed_sum_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session(cpus, "millrace-bench")
    discard(REGISTRY["tpch_q6"](spark, folder))  # start-up is not timed
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        discard(REGISTRY[name](spark, folder))
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

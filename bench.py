"""Run the headline queries and print one JSON line with their seconds.

Every query is timed over full materialization (``noop`` sink); the better of two runs counts, after a few
runs that only warm up the JVM.
"""

from __future__ import annotations

import json
import os
import time

from tidegauge.session import local_session
from workload.catalog import QUERIES

HEADLINE = (
    "rollup_1h",
    "rollup_1d",
    "rollup_1w",
    "rollup_1month",
    "entity_rollup",
    "entity_rollup_1d",
    "sum_array",
    "completeness",
    "kpi_from_trends",
    "kpi_multi_granularity",
    "exception_join",
    "attribute_as_of_join",
    "attribute_run_length",
    "attribute_compact",
    "attribute_transfer",
    "upsert_partial",
    "process_modified_log",
    "fingerprint_window",
    "incremental_rollup",
    "create_notifications",
    "resolve_entities",
    "refresh_stats",
    "lineage_closure",
    "stream_rollup",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus))

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    for _ in range(3):
        run(HEADLINE[0])
    seconds = {}
    for name in HEADLINE:
        times = [run(name) for _ in range(2)]
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

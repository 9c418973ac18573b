"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES``
optionally the queries (comma-separated, or ``all``). Every query is computed in
full into the no-op sink, so no column is pruned away.
"""

from __future__ import annotations

import json
import os
import time

from tarmac.session import local_session
from tarmac.workload.queries import queries

HEADLINE = [
    "bronze_flights",
    "dq_null_profile",
    "dq_flag_distribution",
    "dq_row_status",
    "dedup_unique",
    "dedup_duplicates",
    "dedup_report",
    "join_both_airports",
    "feat_haversine",
    "silver_flights",
    "bronze_partitioned_roundtrip",
    "incremental_batch_rerun",
    "incremental_late_file",
    "incremental_silver_merge",
    "gold_route_from_months",
    "cancelled_by_year_month",
    "gold_airline_kpi",
    "gold_route_kpi",
    "gold_airport_departure_kpi",
    "gold_delay_cause",
    "kpi_p95_arrival_delay",
    "vw_airline_scorecard",
    "network_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    chosen = os.environ.get("BENCH_QUERIES", "")
    registered = queries()
    names = list(registered) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    spark = local_session(cores, shuffle_partitions=cores)
    seconds = {}
    # One untimed run starts the executor threads and compiles common code.
    registered["gold_airline_kpi"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of threads, BENCH_ALL=1 runs every query.
Results are written to the no-op sink, so all rows and columns are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import query_catalog  # noqa: E402
from remitlake.session import build_session  # noqa: E402

HEADLINE = [
    "global_metrics_month",
    "global_metrics_day",
    "backfill_month",
    "asof_convert",
    "dedup_transactions",
    "rejects_ok",
    "stage_transactions_day",
    "stream_land_counts",
    "profile_by_day",
    "status_done_metrics",
    "rates_as_of_day",
    "dash_turnover",
    "fact_done",
    "upsert_by_object_id",
    "by_date_copy_transactions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = query_catalog.all_queries()
    names = list(queries) if os.environ.get("BENCH_ALL") else HEADLINE
    # Start executors, code generation and the Python workers before the clock.
    for name in ("global_metrics_day", "stream_land_counts"):
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()

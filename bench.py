"""Time the headline queries; prints one JSON line.

Every result is computed in full and thrown away (``noop`` sink). Settings:
``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores), ``BENCH_QUERIES``
(comma-separated names, or ``all``).
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans.queries import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "get_range",
    "get_all",
    "get_found_series",
    "overlay_latest",
    "overlay_contested",
    "overlay_mixed",
    "combine_first_join",
    "agg_mean",
    "agg_std",
    "agg_overlaid_mean",
    "agg_hot_series",
    "agg_tick",
    "agg_dense",
    "agg_gaps",
    "resample_1h_std",
    "pivot_series",
    "series_extent",
    "infer_value_type",
    "validate_files",
    "incremental_manifest",
    "stored_round_trip",
    "search_ns",
    "search_value",
    "series_info",
    "metadata_upsert",
    "stream_queue",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    run("agg_mean")  # start-up and class loading are not part of any query
    seconds = {}
    for name in names:
        seconds[name] = run(name)
        print(f"{name:24s}{seconds[name]:8.3f}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma-separated,
default all of HEADLINE). Results are computed in full and discarded by the noop sink.
"""

from __future__ import annotations

import json
import os
import time
import warnings

from placemill.session import local_session
from placemill_checks import frames
from placemill_checks.queries import QUERIES

HEADLINE = [
    "extract_flatten", "dedup_best_provider", "provider_composition", "compare_sources", "spatial_dup_report",
    "capture_rate_by_radius", "spatial_anti_join_grocery", "spatial_anti_join_fresh", "assign_region_of_place",
    "assign_shop_area", "build_master", "date_normalize", "register_normalize", "register_merge",
    "column_completeness", "registry_scan", "tile_pyramid", "tile_thinning",
]


def main() -> None:
    warnings.filterwarnings("ignore", message=".*no column.*")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    frames.prepare(spark, sf_dir)
    seconds = {"prepare_input_views": round(time.perf_counter() - start, 3)}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()

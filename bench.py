"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list, optional)
Each query is executed to completion through the ``noop`` sink (full computation, no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "curated_streams",
    "dq_gates",
    "genre_kpis_daily",
    "top_songs_by_genre_daily",
    "top_genres_daily",
    "v_genre_kpis",
    "serving_genre_kpis",
    "serving_upsert",
    "star_dq_gates",
    "star_genre_kpis_daily",
    "star_top_songs_by_genre_daily",
    "validation_errors",
    "manifest",
    "metric_rollup",
    "alarm_states",
    "late_rebuild",
    "silver_gold_jobs",
    "stream_ingest_kpis",
    "batch_run_serving",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE

    from lakekpi.registry import QUERIES
    from lakekpi.session import build_session

    spark = build_session(f"local[{cpus}]", app="lakekpi-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", max(8, cpus))))
    # warm the JVM and the Parquet readers once (not timed)
    QUERIES["genre_kpis_daily"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    for q in names:
        t0 = time.perf_counter()
        QUERIES[q](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[q] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

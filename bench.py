"""Benchmark the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3; training queries run once), BENCH_QUERIES (comma list).
Each query is forced with the ``noop`` sink after one warm-up query; the
value per query is the median wall time in seconds.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lagoon.plans import catalog  # noqa: E402
from lagoon.session import local_session  # noqa: E402

HEADLINE = [
    "fit_stats", "lag_scaled", "sequence_long", "mask_long", "stacked_long",
    "split_train", "train_roundtrip", "shard_counts", "regression_metrics", "auc_by_rank",
    "stream_is_even", "stream_sequence", "gbt_forecast", "seqnet_train",
]
RUN_ONCE = {"gbt_forecast", "seqnet_train", "gbt_cv", "seqnet_score", "logit_scores"}


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = local_session(cpus, shuffle_partitions=max(2 * cpus, 8), app="lagoon-bench", memory="7g")
    queries = catalog.QUERIES

    force(queries["split_train"](spark, sf_dir))          # warm-up: JVM, Python workers, file cache
    timings, rows = {}, {}
    for name in names:
        runs = []
        for _ in range(1 if name in RUN_ONCE else repeats):
            t0 = time.perf_counter()
            force(queries[name](spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
        print(f"# {name}: {timings[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {
        "metric": "total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "rows": rows,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()

"""Benchmark of the headline queries: one JSON line with the seconds per query.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the table directory, BENCH_CPUS the number of local cores,
BENCH_RUNS the number of runs per query, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from larder.plans import catalog
from larder.session import local_session

HEADLINE = [
    "score_food", "named_aggs", "feature_rows", "incremental_ingest", "update_by_key", "pair_compare", "split_label",
    "fixed_batches", "convert_units", "fix_recipe_units", "repair_lines", "token_counts", "assign_category",
    "centroid_similarity", "histogram_scores", "describe_prices", "quality", "drift_report", "line_drift",
    "regression_quality", "qq_points", "rolling_quality", "linear_r2",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus)

    def run(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("score_min_max")  # starts the executor threads and the code cache
    seconds = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in names}
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": root.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus,
    }))


if __name__ == "__main__":
    main()

"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  A query is executed to the
end with the ``noop`` sink (nothing is collected to the driver).  Queries that
finish their first (warm-up) run under ``FAST`` seconds are run three more
times and the median of those is kept; slower ones keep the first timing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabforge.session import get_spark  # noqa: E402

HEADLINE = [
    "quantiles", "robust_scale", "fill_group_median", "fill_group_mode", "mode_impute",
    "one_hot", "drop_unshared_levels", "null_report", "skew_report", "correlated_pairs",
    "boxcox_mle", "skew_fix", "knn_impute", "adjust_tails", "blend", "ridge_fit", "engineered",
    "fit_predict",
]
FAST = 30.0


def run(fn, spark, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", app="tabforge-bench", shuffle_partitions=cpus,
                      driver_memory="16g")
    from tabforge.plans.queries import QUERIES
    names = [n for n in HEADLINE if n in QUERIES]
    run(QUERIES["value_counts"], spark, sf_dir)  # JVM and file-listing warm-up
    times = {}
    for name in names:
        first = run(QUERIES[name], spark, sf_dir)
        if first < FAST:
            times[name] = round(statistics.median([run(QUERIES[name], spark, sf_dir)
                                                   for _ in range(3)]), 3)
        else:
            times[name] = round(first, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()

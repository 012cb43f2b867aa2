"""Benchmark: time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the no-op sink (every row produced, none
collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from promo_engine.plans.catalog import QUERIES  # noqa: E402
from promo_engine.session import local_session  # noqa: E402

HEADLINE = [
    "clean_offline", "label_15d", "received_vs_label_by_rate", "daily_received", "null_profile",
    "split_windows", "feat_H_user", "feat_L_user", "dataset_assembled", "dataset_compact",
    "dataset_user_block", "train_union", "centroid_distance", "lloyd_step", "silhouette_labels",
    "kmeans_assign", "gbt_user_block_predictions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), "promo_bench")
    # warm-up: JVM class loading and the parquet footer cache, not timed
    QUERIES["distance_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()

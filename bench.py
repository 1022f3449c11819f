"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each headline query is materialised twice (``collect`` of the small result,
or a ``noop`` write for row-sized results): the first run pays JIT and
whole-stage-codegen compilation, which is a fixed cost per query rather than
per row; the second run is the reported time.  Cold times are printed too.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from labelfold.plans.catalog import QUERIES  # noqa: E402
from labelfold.session import build_session  # noqa: E402

HEADLINE = [
    "per_label_metrics", "overall_metrics", "classification_report", "roc_auc", "roc_auc_continuous",
    "threshold_sweep", "per_label_report", "top_label_combinations", "hard_examples",
    "score_histogram", "evaluation_loss", "dataset_statistics", "class_weights_neg_pos",
    "truth_label_combinations", "linear_head_scores", "score_batch", "length_profile",
    "best_metric", "early_stop", "training_curves", "recent_history", "recent_history_clear", "validate_requests",
    "detailed_predictions", "fit_linear_head_focal", "fit_binary_relevance",
]
ROW_SIZED = {"detailed_predictions", "linear_head_scores", "score_batch", "training_curves",
             "validate_requests", "recent_history", "recent_history_clear"}


def materialise(name, df):
    if name in ROW_SIZED:
        df.write.format("noop").mode("overwrite").save()
    else:
        df.collect()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="labelfold-bench", shuffle_partitions=max(8, cpus),
                          extra={"spark.driver.memory": "8g"})
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="labelfold-bench-"))
    # warm-up: JIT, file listing, Python workers
    materialise("per_label_metrics", QUERIES["per_label_metrics"](spark, sf_dir))
    times, cold = {}, {}
    for name in names:
        t0 = time.perf_counter()
        materialise(name, QUERIES[name](spark, sf_dir))
        cold[name] = round(time.perf_counter() - t0, 3)
        t0 = time.perf_counter()
        materialise(name, QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus,
           "cold_total": round(sum(cold.values()), 3), "queries_cold": cold}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

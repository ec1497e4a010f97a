"""Time the headline queries on the test tables and print one line of JSON."""

from __future__ import annotations

import json
import os
import time

from fcbias.catalog import QUERIES
from fcbias.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CORES = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
HEADLINE = [
    # A: training table
    "pivot_avg",
    "join_obs",
    "lead_thinning",
    "lead_bias_window",
    "build_training_table",
    "feature_table_train",
    # B: scores and models
    "rmse_by_lead",
    "mae_by_fold",
    "hist2d_density",
    "density_at_points",
    "train_gbt",
    # C: quality control and gridding
    "zscore_by_time",
    "dedup_keep_first",
    "observation_qc",
    "join_nearest_cell",
    "feature_table_serve",
    "join_neighbours_radius",
    "topk_neighbours",
    "oi_weights",
    "oi_analysis",
    "correct_grid",
]


def main() -> None:
    spark = build_session("bench", cores=CORES)
    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(sorted(runs)[len(runs) // 2], 3)
    sf = os.path.basename(os.path.normpath(FOLDER)).removeprefix("sf")
    print(json.dumps({"metric": "total of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()

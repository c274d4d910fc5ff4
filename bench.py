"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of the tables; BENCH_CPUS: local threads.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldlens.session import build_session  # noqa: E402
from fieldlens.workload import QUERIES  # noqa: E402

HEADLINE = (
    "band_means_at_survey", "band_mean_wide", "band_mean", "cloud_flag", "asof_nearest", "asof_nearest_series", "clip_pixels",
    "contains_join", "mean_ndvi", "band_histogram", "stack_bands", "project_utm", "corr_matrix", "box_stats_events",
    "top_band_sets", "stratified_folds", "knn", "band_gram", "band_search",
)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = build_session(
        f"local[{cpus}]", cpus, **{"spark.driver.memory": "16g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    # start the session's code generator and Python workers outside the clock
    QUERIES["mean_ndvi"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()

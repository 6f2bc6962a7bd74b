"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is fully executed with the ``noop`` sink (whole plan runs, nothing
is collected to the driver). Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_trips",
    "avg_duration_by_hour",
    "retention_report",
    "describe_duration",
    "financial_summary",
    "corr_matrix",
    "histogram_money",
    "box_by_passenger",
    "discrepancy_rate",
    "exact_split",
    "dict_vectorize_long",
    "validate_ranges",
    "rejects_by_rule",
    "reject_whole_request",
    "latency_summary",
    "regression_metrics",
    "fit_linear",
    "score_batch",
    "model_comparison_5_trees_depth_8",
]

#: The published batch throughput is that of a forest of 100 trees. The forest that is scored
#: here has the default settings (100 trees, depth 30, 256 bins), fitted on about so many trips.
FOREST_ROWS = 20_000


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    from sparktrips.session import build_session
    from sparktrips.plans import catalog, q_model

    spark = build_session(f"local[{cpus}]", app="sparktrips-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    catalog.load_all()
    names = only or HEADLINE
    # Warm-up: JVM, parquet footers and first codegen, not timed.
    catalog.QUERIES["trip_duration"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for n in names:
        q_model._FITTED.clear()  # each query pays for its own fit, in whatever order they run
        t0 = time.perf_counter()
        df = catalog.QUERIES[n](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    # Scoring throughput, fits apart: a full pass that scores every cleaned trip with
    # the linear pipeline and with a forest of 100 trees (comparable to the published
    # batch rows/s).
    from sparktrips.config import DEFAULT_SETTINGS
    from sparktrips.operators import clean, model
    from sparktrips.sources import views
    trips = model.training_frame(clean.clean_trips(views.trips(spark, sf_dir))).cache()
    n_rows = trips.count()
    settings = DEFAULT_SETTINGS
    sample = trips.sample(min(1.0, FOREST_ROWS / max(1, n_rows)), seed=1)
    fit_s, score_s = {}, {}
    for kind, rows in (("linear_regression", trips), ("random_forest", sample)):
        t0 = time.perf_counter()
        fitted = model.train_pipeline(rows, model.create_model(kind, settings), settings)
        fit_s[kind] = round(time.perf_counter() - t0, 3)
        for _ in range(2):  # the first pass compiles code
            t0 = time.perf_counter()
            model.score(fitted, trips).write.format("noop").mode("overwrite").save()
            score_s[kind] = time.perf_counter() - t0
    trips.unpersist()
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": int(cpus),
        "score_rows": n_rows,
        "fit_seconds": fit_s,
        "score_rows_per_sec": round(n_rows / score_s["linear_regression"], 1),
        "forest_100_trees_rows_per_sec": round(n_rows / score_s["random_forest"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oddrows.plans import catalog  # noqa: E402
from oddrows.session import local_session  # noqa: E402

HEADLINES = [
    "severity_counts", "missing_profile", "describe", "quantiles_linear", "equal_width_histogram", "density_curve",
    "calendar_resample_hourly", "attach_event_text", "label_by_ranges", "rolling_mean_std", "sliding_windows",
    "autocorrelation", "outlier_regions", "zscore", "iqr_fence", "contamination_threshold", "kmeans_distance_outliers",
    "cblof", "hbos", "knn_distance_1d", "knn_distance", "isolation_forest_100", "pca_project",
    "sequence_reconstruction_error", "ar_forecast_ten_lags", "seasonal_ar_predict", "gaussian_residual_score",
    "roc_auc", "fbeta_sweep", "regression_errors", "texts_to_sequences", "pooled_text_vector",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before timing
    times = {}
    for name in HEADLINES:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

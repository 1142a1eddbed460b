"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and once for the clock; the whole result is computed each time.
Settings: BENCH_SF_DIR (tables), BENCH_CPUS (local cores).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowlab.plans import catalog  # noqa: E402
from flowlab.session import build_session  # noqa: E402

HEADLINE = [
    "b1_time_split_column", "b6_fit_median", "b9_drop_duplicates", "b10_remove_outliers_iqr", "b16_preprocess",
    "c10_engineer_features", "c14_connection_features", "c18_scale_continuous", "c19_stratified_split", "c20_smote",
    "d1_quality_report", "d6_correlation_matrix", "d7_histogram_by_class", "d14_batch_summary", "d16_running_totals",
    "e7_gaussian_nb_parameters", "e8_isolation_forest", "f4_average_precision", "f6_rank_metrics_many_scores",
    "f8_classification_report", "f11_leaderboard", "g1_predict", "g5_stream_score", "g8_windowed_features",
    "g8_trailing_sums", "g9_source_context", "j1_join_labels", "s3_with_gap_sliced",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session("bench", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"}, f"local[{cpus}]")
    spark.sparkContext.setLogLevel("ERROR")
    catalog.load_all()
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.time()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()

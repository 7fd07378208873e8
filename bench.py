"""Time the registered queries: prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. Each query runs once
to warm up the JVM and then twice; the faster run counts. All result columns are produced: the
result goes to Spark's noop sink. Name queries on the command line to time only those.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from linewright.plans import catalog
from linewright.session import build_session

HEADLINE = [
    "training_set",
    "window_family",
    "window_1h",
    "window_24h",
    "window_7d",
    "window_30d",
    "window_lines_30d",
    "window_sliding",
    "rolling_features",
    "degradation_signal",
    "interval_join",
    "interval_join_units",
    "asof_features",
    "asof_events",
    "asof_windows",
    "quarantine_split",
    "rule_violations",
    "profile_machine",
    "profile_supplier",
    "feature_lookup",
    "changed_rows",
    "latest_per_key",
    "null_profile",
    "validation_summary",
    "temporal_split",
    "class_weights",
    "impute_rename",
    "category_index",
    "quantile_bucket",
    "standard_scale",
    "auc_exact",
    "threshold_sweep",
    "drift_psi",
    "drift_quantile_bins",
    "equalized_odds",
    "stream_window_24h",
    "logistic_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs[1:]), 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    sf = float(os.path.basename(folder.rstrip("/")).removeprefix("sf") or 0)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()

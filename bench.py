"""Times the registered queries at one scale factor and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the local cores. Each time covers building
and running one query to the end (every output row is produced, none is kept); it is the
better of two runs, so that loading and compiling code counts once at most.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checkset.queries import QUERIES  # noqa: E402
from cohortlens.session import build_session  # noqa: E402

HEADLINE = [
    "clean_events",
    "clean_events_sql",
    "weekly_features",
    "weekly_features_sql",
    "risk_target",
    "course_target_summary",
    "click_features",
    "click_study_matrix",
    "column_summary",
    "correlations",
    "linear_score",
    "risk_snapshot",
    "student_risk_mart",
    "course_summary",
    "course_summary_sql",
    "risk_weekly_mart",
    "top_k_at_risk",
    "alert_row",
    "quality_checks",
    "module_heatmap",
    "time_split",
    "stratified_split",
    "confusion",
    "roc_auc",
    "roc_points",
    "z_test",
    "bootstrap_ci",
    "experiment_readout",
    "roi_grid",
    "train_logistic",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    wanted = sys.argv[1:] or HEADLINE
    # one untimed query loads classes; the timed ones then share a warm session
    QUERIES["course_target_summary"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in wanted:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    found = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

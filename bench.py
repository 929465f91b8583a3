"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm up, then 3 times; the median is reported. Results
are forced with the `noop` sink (full execution, nothing collected to the
driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelscope.plans.catalog import QUERIES  # noqa: E402
from panelscope.session import local_session  # noqa: E402

HEADLINE = [
    "clean_panel",
    "yearly_features",
    "monthly_features",
    "training_filter_counts",
    "split_by_outcome",
    "flag_top_quartile",
    "backtest_summary",
    "calibration_deciles",
    "risk_percentile",
    "score_requests",
    "resolve_names",
    "train_job",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - t0
    spark.catalog.clearCache()
    return elapsed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        # Stage / task times without the UI: Spark's event log in a fresh scratch folder.
        log_dir = tempfile.mkdtemp(prefix="panelscope-events-")
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
        print(f"event log: {log_dir}", file=sys.stderr)
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="panelscope-bench",
                          extra_conf=extra)
    results, errors = {}, {}
    for name in names:
        try:
            run_once(spark, name, sf_dir)  # warm-up
            results[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(repeats)), 3)
        except Exception as exc:  # noqa: BLE001 - one failing query must not hide the others' numbers
            results[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc).splitlines()[0][:200] if str(exc) else ''}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(v for v in results.values() if v is not None), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

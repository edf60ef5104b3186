"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_REPEATS`` (default 2; the best counts), ``BENCH_QUERIES`` (names, by comma).
Each result is written to Spark's ``noop`` sink, so all rows and columns are computed
and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gridlake.plans.queries import registered  # noqa: E402
from gridlake.session import build_session  # noqa: E402

HEADLINE = (
    "parse_envelope",
    "replay_safe_batch",
    "write_plan",
    "hourly_coverage",
    "clean_region",
    "clean_fuel",
    "clean_power",
    "quality_report",
    "conflicting_keys",
    "region_hourly",
    "fuel_hourly",
    "power_monthly",
    "dim_respondent",
    "merge_latest",
    "upsert_stage",
    "region_daily",
    "grid_status",
    "grid_alerts",
    "planning_daily",
    "power_mart",
    "grid_watchlist",
    "planning_thresholds",
    "reconcile_summary",
    # write paths and the widest plans
    "ingest_available_now",
    "merge_partitions",
    "upsert_table",
    "dim_fuel_type",
    "mart_checks",
    "reconcile_snapshot",
    "table_counts",
)


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    shared = tempfile.mkdtemp(prefix="gridlake-bench-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus),
        **{
            "spark.checkpoint.dir": shared,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = registered()
    spark.read.parquet(f"{root}/events.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            started = time.perf_counter()
            known[name](spark, root).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
        print(f"{name:24s} {seconds[name]:8.3f}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(root).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

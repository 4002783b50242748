"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of test tables, ``BENCH_CPUS`` the local cores. Every query
runs once to warm up and ``BENCH_RUNS`` times for the median; results go to a null sink, so
all rows are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from accountpulse.plans.jobs import weekly_jobs  # noqa: E402
from accountpulse.plans.pipeline import merge_exports, stage_exports  # noqa: E402
from accountpulse.session import build_session  # noqa: E402
from checks.registry import QUERIES  # noqa: E402
from checks.workspace import SETTINGS, catalog  # noqa: E402

HEADLINE = (
    "session_billing_weekly",
    "signups_weekly",
    "kyc_steps_weekly",
    "kyc_hil_government_weekly",
    "connect_licenses_weekly",
    "marketplace_long",
    "workflow_executions_weekly",
    "daily_active_users_weekly",
    "kyc_funnel",
    "steps_enriched",
    "merged_weekly",
    "weekly_totals",
    "monthly_companies",
    "period_change",
    "big_decliners",
)


def full_weekly_run(spark, folder):
    """Raw tables to merged table, with nothing staged beforehand."""
    return merge_exports(stage_exports(weekly_jobs(catalog(spark, folder), SETTINGS)), SETTINGS)


def timed(build, spark, folder) -> float:
    started = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or [*HEADLINE, "full_weekly_run"]
    builds = {**QUERIES, "full_weekly_run": full_weekly_run}
    seconds = {}
    for name in names:
        timed(builds[name], spark, folder)
        seconds[name] = round(statistics.median(timed(builds[name], spark, folder) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()

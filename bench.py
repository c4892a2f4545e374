"""Time the reports and print one JSON line.

Follows the protocol of the source benchmark: one untimed warm-up per query,
then timed runs. Results go to the noop sink, because counting a query lets
the optimizer drop the columns nobody reads.

BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and BENCH_QUERIES (comma-separated names)
override the defaults.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from acadmetric.catalog import load
from acadmetric.session import drop_written, local_session

# The eight queries the source benchmark times, in their timed forms.
HEADLINE = (
    "timed_outputs_per_program", "timed_graduates_per_program", "timed_active_students", "timed_collabs_per_program",
    "timed_productive_programs", "timed_star_faculty", "timed_top3_faculty", "timed_program_totals",
)

# The heaviest operators beside the reports.
OPERATORS = (
    "win_rank_global", "win_rank_partition", "win_row_number_agg", "win_row_number_time", "win_percent_rank", "win_cume_dist", "win_ntile",
    "agg_multi_distinct", "dq_rule_counts", "dq_foreign_key", "layout_by_key", "audit_checked_changes",
)

# A query is not repeated further when it has taken so many seconds in all.
ENOUGH = 6.0

# Corrected variants of reports are left out of the sum.
VARIANTS = ("_once_per_project", "_titled", "_all", "_every_year")


def seconds(spark: SparkSession, run, folder: str) -> float:
    start = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    queries = load().QUERIES
    reports = [n for n in queries if n.startswith(("qi", "qa")) and not n.endswith(VARIANTS)]
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or [*reports, *HEADLINE, *OPERATORS]
    folder_of_run = tempfile.mkdtemp(prefix="acadmetric-bench-")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, folder=folder_of_run)
    for name in names[:3]:  # the session itself warms up on these
        seconds(spark, queries[name], folder)
    times = {}
    for name in names:
        seconds(spark, queries[name], folder)
        taken: list[float] = []
        while len(taken) < 2 or len(taken) < runs and sum(taken) < ENOUGH:
            taken.append(seconds(spark, queries[name], folder))
        times[name] = round(statistics.mean(taken), 3)
    drop_written(spark)
    print(json.dumps({
        "metric": "sum of mean report times",
        "value": round(sum(v for n, v in times.items() if n not in OPERATORS), 3),
        "unit": "sec",
        "queries": times,
        "headline": round(sum(times.get(n, 0.0) for n in HEADLINE), 3),
        "operators": round(sum(times.get(n, 0.0) for n in OPERATORS), 3),
        "cores": cpus,
        "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

"""Time the headline queries in the order of a nightly run.

A run starts from the driver tables alone. Later queries read the tables earlier ones wrote, as
the jobs of a night do, and a table's cost counts for the first query that needs it: the total is
the time of the whole run. Set ``BENCH_ISOLATED=1`` to make every query build its own tables.
A small warm-up run comes first. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import time

from clearshelf.plans.queries import run
from clearshelf.plans.workspace import forget_workspaces
from clearshelf.session import local_session

HEADLINE = (
    "daily_sales",
    "first_level_features",
    "second_level_features",
    "train_val_test",
    "eval_planned",
    "eval_manual",
    "disagg_final",
    "target_encode",
    "metrics_overall",
    "metrics_weekly",
    "error_by_category",
    "elasticity_check",
    "best_markdown",
    "cart_members_week_back",
    "online_units_week_back",
    "dq_not_null",
)


def timed(spark, name: str, sf_dir: str) -> float:
    if os.environ.get("BENCH_ISOLATED") == "1":
        forget_workspaces()
    start = time.perf_counter()
    run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def warm_up(spark, sf_dir: str) -> None:
    """One unreported run on a smaller folder, so that class loading and compilation of the JVM
    are not charged to the first queries."""
    smaller = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    if os.path.isdir(smaller):
        for name in HEADLINE:
            timed(spark, name, smaller)
    else:
        timed(spark, "daily_sales", sf_dir)
    forget_workspaces()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    warm_up(spark, sf_dir)
    times = {name: timed(spark, name, sf_dir) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Headline timings. Prints one JSON line.

BENCH_SF_DIR  test-data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.plans.pipeline import run_pipeline  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources import FrameSource  # noqa: E402
from tidemark.verify.queries import all_queries, new_warehouse, two_states  # noqa: E402

HEADLINE = [
    "clean_orders",
    "silver_order_items",
    "quarantine_reason_counts",
    "two_loads_orders",
    "upsert_many_targets",
    "fact_orders",
    "customer_summary",
    "product_summary",
    "profile_grain",
    "profile_nulls",
    "profile_orphans",
    "profile_fanout",
    "reconcile_gold",
    "product_seller_pairs",
    "shuffled_sample",
]
REPEATS = 3


def layer_runs(spark, folder: str) -> dict[str, float]:
    """All layers end to end: first load, a large change set, nothing new."""
    before, after = two_states(spark, folder)
    warehouse = new_warehouse(spark)
    taken = {}
    for name, state in (
        ("layers_first_load", before),
        ("layers_change_set", after),
        ("layers_nothing_new", after),
    ):
        start = time.perf_counter()
        run_pipeline(warehouse, FrameSource(state))
        taken[name] = round(time.perf_counter() - start, 3)
    return taken


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    available = all_queries()
    names = sys.argv[1:] or HEADLINE
    timings = {}
    for name in names:
        taken = []
        for _ in range(1 + REPEATS):  # the first run warms up
            start = time.perf_counter()
            available[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(taken[1:]), 3)
    if not sys.argv[1:]:
        timings |= layer_runs(spark, folder)
    print(
        json.dumps(
            {
                "metric": "total seconds: warm median per query, plus three runs of all layers",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

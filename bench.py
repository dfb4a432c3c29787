"""Headline timings, printed as one JSON line.

Each query runs once to warm up and then twice; the better time counts. The drain and the generator
run twice, the drain into a new lake each time, from messages landed beforehand. Query results are
computed in full and written nowhere.
"""

from __future__ import annotations

import json
import os
import time

from tidemart.plans import generator
from tidemart.queries import QUERIES
from tidemart.queries.common import landing
from tidemart.queries.lake import new_lake
from tidemart.session import build_session
from tidemart.sources.messages import from_files
from tidemart.streaming import pipeline

HEADLINE = [
    "daily_customer_analytics",
    "daily_customer_analytics_dated",
    "daily_sales_summary",
    "product_performance_analytics",
    "bronze_raw_events",
    "silver_purchases",
    "dq_accept_reject_counts",
    "purchase_items_exploded",
    "medallion_sales_summary",
]
GENERATED = 500_000


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def computed(rows) -> None:
    rows.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        settings={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = [seconds(lambda: computed(QUERIES[name](spark, folder))) for _ in range(3)]
        times[name] = min(runs[1:])

    messages = landing(spark, folder)
    drains = []
    for _ in range(2):
        lake = new_lake(spark)
        drains.append(seconds(lambda: pipeline.drain(lake, from_files(spark, messages))))
    times["drain_bronze_and_silver"] = min(drains)
    events = lake.read("bronze", "raw_events").count()

    shop = generator.Shop()
    made = shop.messages(generator.numbered(spark, GENERATED))
    times["generate_messages"] = min(seconds(lambda: computed(made)) for _ in range(2))

    print(
        json.dumps(
            {
                "metric": "total seconds of the headline jobs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "drained_events_per_sec": round(events / times["drain_bronze_and_silver"]),
                "generated_events_per_sec": round(GENERATED / times["generate_messages"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

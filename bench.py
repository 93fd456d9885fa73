"""Time the headline queries; prints one JSON line.

``ingest`` reads the raw log from CSV, cleans it and stores it; the products
read the stored log, so the sum is the cost of all products from raw data.  The
raw log itself is laid down beforehand.  Each time is the median of three runs
after one to warm up, over complete results.  ``jobs`` in the line are single
runs of each job, from stored table to stored table, not part of the value.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from basketflow.plans import jobs
from basketflow.plans.queries import REGISTRY
from basketflow.plans.scratch import scratch_path
from basketflow.plans.standin import shop_log
from basketflow.session import build_session, settings
from basketflow.sources.events import read_events_csv, write_events_csv

PRODUCTS = [
    "pairs_ranked",
    "user_affinity",
    "user_source_items",
    "user_recommendations",
    "user_profiles_nested",
    "flag_abandoned_items",
    "lookup_batch",
]


def seconds(run, repeats: int = 3) -> float:
    run()
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    conf = settings(input_bytes=0, cores=cpus) | {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("basketflow-bench", conf, master=f"local[{cpus}]")
    spark.sparkContext.setLogLevel("ERROR")

    raw = scratch_path(spark, "raw-log")
    write_events_csv(shop_log(spark, sf_dir).repartition(cpus), raw)

    def ingest() -> None:
        jobs.store_events(read_events_csv(spark, raw), scratch_path(spark, "ingest"))

    def product(name: str):
        return lambda: REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {"ingest": seconds(ingest)}
    print("ingest", times["ingest"], file=sys.stderr, flush=True)
    for name in PRODUCTS:
        times[name] = seconds(product(name))
        print(name, times[name], file=sys.stderr, flush=True)
    root = scratch_path(spark, "jobs")
    paths = jobs.table_paths(root)
    jobs.store_events(read_events_csv(spark, raw), paths["events"])
    each = {
        "items": lambda p: jobs.item_numbers(spark, p["events"], p["items"]),
        "pairs": lambda p: jobs.market_basket(spark, p["events"], p["pairs"], items_path=p["items"]),
        "affinity": lambda p: jobs.affinity(spark, p["events"], p["affinity"]),
        "source_items": lambda p: jobs.source_items(spark, p["events"], p["source_items"]),
        "neighbours": lambda p: jobs.neighbours(spark, p["pairs"], p["neighbours"]),
        "pair_documents": lambda p: jobs.load_pairs(spark, p["pairs"], p["pair_documents"]),
        "profiles": lambda p: jobs.load_profiles(
            spark, p["affinity"], p["source_items"], p["neighbours"], p["pairs"], p["profiles"]
        ),
        "targeting": lambda p: jobs.cart_abandonment(
            spark, p["events"], p["profiles"], p["targeting"], figures_path=p["figures"]
        ),
    }
    job_times = {}
    for name, job in each.items():
        start = time.perf_counter()
        job(paths)
        job_times[name] = round(time.perf_counter() - start, 3)
    print("jobs", job_times, file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "all six products, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "jobs": job_times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

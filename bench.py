"""Times the headline operators over stored tables and prints one JSON line.

The events and state tables are derived from the driver tables and written as
Parquet once (``setup``); every operator then reads them the way a deployment
would. Each operator runs once to warm up and ``BENCH_RUNS`` times for the
clock; its result goes to Spark's noop sink, so all columns of all rows are
computed.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from devmetrics import configure
from devmetrics.registry import BUILDERS, present
from devmetrics.sources.derived import DerivedEvents, StoredEvents

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "integration_events",
    "prstats",
    "prstats_pull_requests",
    "prstats_pull_request_reviews",
    "merged_pull_requests",
    "enrich_events",
    "unwrap_messages",
    "validate_webhooks",
    "route_failed_writes",
    "commits_to_review",
    "commit_approval",
    "commit_review_status",
    "artifact_queue",
    "artifact_status",
    "artifact_pr_comments",
    "publisher_source",
    "failed_deliveries",
    "reconcile_redeliveries",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("devmetrics-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)

    folder = tempfile.mkdtemp(prefix="devmetrics-bench-")
    started = time.perf_counter()
    stored = StoredEvents.write(DerivedEvents(spark, SF_DIR), folder)
    setup = time.perf_counter() - started

    def run(name: str) -> float:
        begin = time.perf_counter()
        present(BUILDERS[name](stored)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)

    result = {
        "metric": "total_seconds_headline_operators",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "events": stored.events.count(),
        "setup_sec": round(setup, 3),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

Each query runs twice to warm up and then three times into a sink that discards the
rows; the median counts.  Whole runs (the day job, landing and the hour job, compaction,
a minute stream) are timed once.  Set BENCH_SF_DIR and BENCH_CPUS to change the input and
the number of cores, BENCH_QUERIES (comma-separated) to time others.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from topicflow.plans import jobs, queries  # noqa: E402
from topicflow.session import local_session, run_dir  # noqa: E402
from topicflow.sinks.store import Store  # noqa: E402
from topicflow.sources import adapter  # noqa: E402

HEADLINE = [
    "parse_tweets", "rejects_by_reason", "envelope", "topic_explode", "trends_city_day", "trends_world_hour",
    "trends_city_minute", "trends_all_levels_day", "top_country_day", "top_world_hour", "slot_summary_day",
    "trend_count", "locations_city", "rt_last_write_wins",
]
LOOKUPS = ["serve_daily", "serve_daily_totals", "serve_topics_day", "timeslots_day", "stats_day"]
# Streams and jobs from lines to tables, once each.
WHOLE = ["landed_hour_job", "compact_day", "stream_minute_all_levels"]
WARM_UPS, RUNS = 2, 3


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, **{
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    registry = queries.registry()

    def discard(name: str) -> None:
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    names = chosen.split(",") if chosen else HEADLINE
    for name in names:
        for _ in range(WARM_UPS):
            discard(name)
        times[name] = round(statistics.median(seconds(lambda: discard(name)) for _ in range(RUNS)), 3)
    if not chosen:
        # The whole day job, from lines to all its tables, then lookups in such tables.
        def day_job() -> None:
            store = Store(spark, run_dir(spark, "bench-day"))
            jobs.run_slots(store, adapter.envelope_lines(spark, sf_dir), "day", "landing_day")

        times["day_job_all_tables"] = round(seconds(day_job), 3)
        for name in LOOKUPS:
            discard(name)
            times[name] = round(statistics.median(seconds(lambda: discard(name)) for _ in range(RUNS)), 3)
        for name in WHOLE:
            times[name] = round(seconds(lambda: discard(name)), 3)
    print(json.dumps({
        "metric": "total_median_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

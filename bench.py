"""Time the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; print one JSON line.

Each query runs once to warm up, then ``$BENCH_RUNS`` times (default 2) in full: every row computed,
none collected. The median counts. ``stage_*`` are the tables of one pipeline run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES, SETTINGS, write_feeds
from plantmetrics.plans.run import Layout, run_layers
from plantmetrics.session import build_session
from plantmetrics.sources import clear_scratch, scratch_path

HEADLINE = (
    "silver_sensors",
    "silver_sensors_chunked",
    "silver_sensors_hot",
    "silver_sensors_hot_window",
    "silver_scada",
    "silver_mes",
    "silver_maintenance",
    "sensors_enriched",
    "gold_kpis_machines",
    "gold_oee",
    "gold_maintenance_cost",
    "gold_production_summary",
    "range_join_left",
    "range_join_naive",
    "range_join_salted",
    "forward_fill",
    "forward_fill_two_level",
    "state_duration",
    "dedup_keep_first",
    "parse_mixed_timestamps",
    "distribution_by_group",
    "distribution_by_group_hot",
    "bronze_sensors",
)


def stage_seconds(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Seconds per table of one run over all layers, from raw files that are already there."""
    layout = Layout(write_feeds(spark, sf_dir), scratch_path(spark, "bench"))
    report = run_layers(spark, layout, SETTINGS).collect()
    for row in report:
        print("stage", row.table, row.rows, round(row.seconds, 2), row.status, file=sys.stderr, flush=True)
    return {f"stage_{row.table}": round(row.seconds, 3) for row in report}


def main(wanted: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in wanted or HEADLINE:
        timings = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timings[1:]), 3)
        print(name, [round(t, 2) for t in timings], file=sys.stderr, flush=True)
    if not wanted:
        seconds.update(stage_seconds(spark, sf_dir))
    clear_scratch(spark)
    spark.stop()
    result = {
        "metric": "seconds of all headline queries and pipeline stages",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main(sys.argv[1:])

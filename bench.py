"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from curbside.plans import registry  # noqa: E402

HEADLINE = [
    "volume_share_month", "volume_month_feed", "volume_day_profile", "volume_zone", "volume_arc",
    "anomaly_yellow", "anomaly_by_zone", "colstats", "fare_tip_curve", "distance_fare_curve",
    "trip_time_bins", "payment_types", "fare_zone", "operator_breakdown", "universal_trips",
    "schema_profile", "sink_repartition", "rolling_stats_batch", "stream_features", "decayed_weight",
]
STREAMS = ["rolling_stats_borough", "rolling_windows", "micro_clusters"]


def run(spark: SparkSession, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    registry.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    with tempfile.TemporaryDirectory(prefix="bench-", ignore_cleanup_errors=True) as scratch:
        spark = builder.config("spark.checkpoint.dir", scratch).getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
        seconds = {}
        for name in HEADLINE:
            run(spark, sf_dir, name)
            seconds[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(repeats)), 3)
        events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
        rates = {}
        for name in STREAMS:
            run(spark, sf_dir, name)
            seconds[name] = round(run(spark, sf_dir, name), 3)
            rates[name] = round(events / seconds[name])
        spark.stop()
    print(json.dumps({
        "metric": "headline queries, total of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "stream_rows_per_sec": rates,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()

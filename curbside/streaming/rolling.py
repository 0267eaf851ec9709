"""Rolling statistics per borough and per top zone over an event stream."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from curbside.operators.rolling import ATTRIBUTES, usable, window_stats
from curbside.session import remove, small_side

# Defaults of the rolling report.
WINDOW_SECONDS = 15 * 60
REPORT_TRIGGER = "10 seconds"
TOP_N = 10
# Reports of older batches are removed.
KEEP_REPORTS = 100

# State slots: the batch at work, the one before it, and a spare.
SLOTS = 3


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}


def _seconds(interval: str) -> int:
    """Length of an interval such as ``15 minutes``."""
    number, unit = interval.split()
    return int(number) * _UNITS[unit.lower().rstrip("s")]


def sliding_stats(stream: DataFrame, key: str, ts: str = "pu_dt", window: str = "15 minutes",
                  slide: str = "1 minute", watermark: str = "15 minutes",
                  values: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """Sliding event-time windows per key.

    Two chained aggregates: panes as long as the slide first, to which every event adds once, then windows of panes. So
    only a pane's sums are copied ``window / slide`` times, not events. Partial sums are formed before the state exchange,
    so a hot key costs one row per task and pane. The first stage drops events later than the watermark and hands a pane
    on when the watermark has passed it; the second reports a window when it has passed the window's end.
    A window that is no multiple of the slide is cut into panes of their greatest common divisor.
    """
    pane = f"{math.gcd(_seconds(window), _seconds(slide))} seconds"
    timed = usable(stream, values).filter(F.col(key).isNotNull()).withColumn("_ts", F.col(ts).cast("timestamp"))
    sums = [F.count(F.lit(1)).alias("_n")]
    for v in values:
        sums += [F.sum(v).alias(f"_{v}_sum"), (F.var_pop(v) * F.count(v)).alias(f"_{v}_spread")]
    panes = timed.withWatermark("_ts", watermark).groupBy(F.window("_ts", pane).alias("_p"), key).agg(*sums)

    n, merged, out = F.col("n"), [F.sum("_n").alias("n")], []
    for v in values:
        of_pane = F.col(f"_{v}_sum")
        merged += [F.sum(of_pane).alias(f"_{v}_sum"), F.sum(F.col(f"_{v}_spread") + of_pane * of_pane / F.col("_n")).alias(f"_{v}_squares")]
        mean = F.col(f"_{v}_sum") / n
        variance = F.greatest(F.lit(0.0), F.col(f"_{v}_squares") / n - mean * mean)
        out += [mean.alias(f"{v}_mean"), F.sqrt(variance).alias(f"{v}_std")]
    return (
        panes.groupBy(F.window("_p", window, slide).alias("_w"), key)
        .agg(*merged)
        .select(
            F.col("_w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("_w.end").cast("timestamp_ntz").alias("window_end"),
            key, "n", *out,
        )
    )


@dataclass
class RollingReport:
    """Exact trailing statistics as of each key's last event, carried from batch to batch.

    The state is three tables below ``path``: the events still inside their key's window, each key's
    last event time and the zone counts since the start. Batches take turns over three slots, so
    the state stays bounded, and a batch that is run again still finds the slot of the batch
    before it and overwrites its own: the report is the same after a failure. Idle keys keep their
    last window. The reports of the last ``keep`` batches stay readable. All of it is partial aggregates and filters; no key is gathered in one task.
    """

    path: str
    window_seconds: int = WINDOW_SECONDS
    top_n: int = TOP_N
    keep: int = KEEP_REPORTS
    values: Sequence[str] = ATTRIBUTES
    ts: str = "pu_dt"

    def _state(self, name: str, batch: int) -> str:
        return f"{self.path}/{name}/slot={batch % SLOTS}"

    def _report(self, batch: int) -> str:
        return f"{self.path}/report/batch={batch}"

    def _top(self, batch: int) -> str:
        return f"{self.path}/top/batch={batch}"

    def _with_earlier(self, spark: SparkSession, name: str, batch: int, rows: DataFrame) -> DataFrame:
        if batch == 0:
            return rows
        return spark.read.schema(rows.schema).parquet(self._state(name, batch - 1)).unionByName(rows)

    def update(self, events: DataFrame, batch: int) -> None:
        """Take in one micro-batch and write the state and report of that batch."""
        spark = events.sparkSession
        events.persist()
        try:
            self._update(spark, events.filter(F.col(self.ts).isNotNull()), batch)
        finally:
            events.unpersist()

    def _update(self, spark: SparkSession, timed: DataFrame, batch: int) -> None:
        counts = timed.filter(F.col("pu_locid").isNotNull()).groupBy("pu_locid").agg(F.count(F.lit(1)).alias("seen"))
        counts = self._with_earlier(spark, "counts", batch, counts).groupBy("pu_locid").agg(F.sum("seen").alias("seen"))
        counts.write.mode("overwrite").parquet(self._state("counts", batch))
        seen = spark.read.schema(counts.schema).parquet(self._state("counts", batch))
        top = seen.orderBy(F.col("seen").desc(), "pu_locid").limit(self.top_n)
        top.write.mode("overwrite").parquet(self._top(batch))

        scopes = F.array(
            F.struct(F.lit("borough").alias("scope"), F.col("pu_borough").alias("key")),
            F.struct(F.lit("zone").alias("scope"), F.col("pu_locid").cast("string").alias("key")),
        )
        fresh = (
            usable(timed, self.values)
            .select(F.explode(scopes).alias("s"), self.ts, *self.values)
            .select("s.scope", "s.key", self.ts, *self.values)
            .filter(F.col("key").isNotNull() & (F.col("key") != ""))
        )
        rows = self._with_earlier(spark, "live", batch, fresh)
        last_path = self._state("last", batch)
        rows.groupBy("scope", "key").agg(F.max(self.ts).alias("last_ts")).write.mode("overwrite").parquet(last_path)
        last = small_side(spark.read.parquet(last_path))
        width = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(self.window_seconds))
        live = rows.join(last, ["scope", "key"]).filter(F.col(self.ts) >= F.col("last_ts") - width)
        live.drop("last_ts").select(*rows.columns).write.mode("overwrite").parquet(self._state("live", batch))
        self.snapshot(spark, batch).write.mode("overwrite").parquet(self._report(batch))
        if batch >= self.keep:
            remove(spark, self._report(batch - self.keep), self._top(batch - self.keep))

    def snapshot(self, spark: SparkSession, batch: int) -> DataFrame:
        """Statistics of every borough and zone over its current window."""
        live = spark.read.parquet(self._state("live", batch))
        return live.groupBy("scope", "key").agg(F.max(self.ts).alias("last_ts"), *window_stats(self.values))

    def boroughs(self, spark: SparkSession, batch: int) -> DataFrame:
        report = spark.read.parquet(self._report(batch))
        return report.filter(F.col("scope") == "borough").drop("scope").withColumnRenamed("key", "pu_borough")

    def top_zones(self, spark: SparkSession, batch: int) -> DataFrame:
        """Top zones by rides since the start, with their window statistics, as of any batch that is kept."""
        top = spark.read.parquet(self._top(batch))
        report = spark.read.parquet(self._report(batch)).filter(F.col("scope") == "zone")
        stats = report.select(F.col("key").cast("int").alias("pu_locid"), *[c for c in report.columns if c not in ("scope", "key")])
        return top.join(stats, "pu_locid", "left")

    def last_batch(self, spark: SparkSession) -> int:
        """Newest batch with a report."""
        return spark.read.option("basePath", f"{self.path}/report").parquet(f"{self.path}/report").agg(
            F.max("batch")
        ).first()[0]

    def writer(self, events: DataFrame, checkpoint: str) -> DataStreamWriter:
        """Streaming writer; set a trigger such as ``REPORT_TRIGGER`` and start it."""
        return events.writeStream.foreachBatch(self.update).option("checkpointLocation", checkpoint)

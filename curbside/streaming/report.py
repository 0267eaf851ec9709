"""Periodic report of a streaming job: a table to which each trigger appends what holds then."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamWriter

from curbside.operators.decay import with_features
from curbside.operators.rolling import ATTRIBUTES
from curbside.session import remove, scratch_path
from curbside.streaming.clusters import MACRO_K, REPORT_TRIGGER as CLUSTER_TRIGGER, macro_clusters, macro_report
from curbside.streaming.events import decode_all
from curbside.streaming.frozen import ClusterTable
from curbside.streaming.rolling import REPORT_TRIGGER, RollingReport

SCHEMA = "reported_at timestamp, scope string, key string, rank int, values map<string,double>, good bigint, bad bigint"


@dataclass
class ReportTable:
    """One folder per micro-batch below ``path``; a batch that is run again replaces its own.

    Rows: when it was reported, a scope and a key in it (a borough, a zone, a cluster), its rank, values by
    name, and how many messages of the batch could be read and how many not.
    """

    path: str

    def append(self, rows: DataFrame, batch: int, good: int, bad: int) -> None:
        """``rows`` has scope, key, rank and values."""
        rows.select(
            F.current_timestamp().alias("reported_at"), "scope", F.col("key").cast("string").alias("key"),
            F.col("rank").cast("int").alias("rank"), "values", F.lit(good).cast("long").alias("good"), F.lit(bad).cast("long").alias("bad"),
        ).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def read(self, spark: SparkSession) -> DataFrame:
        """All reports, with their ``batch``."""
        return spark.read.schema(f"{SCHEMA}, batch bigint").parquet(self.path)


def value_map(df: DataFrame, names: list[str]) -> DataFrame:
    """Scope, key, rank and the named columns as ``values``."""
    pairs = [x for name in names for x in (F.lit(name), F.col(name).cast("double"))]
    return df.select("scope", "key", "rank", F.create_map(*pairs).alias("values"))


def rolling_rows(report: RollingReport, spark: SparkSession, batch: int) -> DataFrame:
    """Every borough's window and those of the zones with the most rides so far, as of a micro-batch."""
    stats = ["n", *[f"{v}_{s}" for v in ATTRIBUTES for s in ("mean", "std")]]
    boroughs = report.boroughs(spark, batch).select(
        F.lit("borough").alias("scope"), F.col("pu_borough").alias("key"), F.lit(None).cast("int").alias("rank"), *stats)
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("seen").desc(), "pu_locid")  # ``top_n`` rows
    zones = report.top_zones(spark, batch).select(
        F.lit("zone").alias("scope"), F.col("pu_locid").cast("string").alias("key"), F.row_number().over(order).alias("rank"), "seen", *stats)
    return value_map(boroughs, stats).unionByName(value_map(zones, ["seen", *stats]))


def cluster_rows(table: ClusterTable, spark: SparkSession, k: int = MACRO_K) -> DataFrame:
    """Macro clusters with their weight, share, hour of day and amounts."""
    names = ["weight", "share", "hour", "distance", "fare", "tip", "duration"]
    found = macro_report(macro_clusters(table.clusters(spark), k))
    return value_map(found.select(F.lit("cluster").alias("scope"), F.col("id").alias("key"), F.col("id").alias("rank"), *names), names)


def report_job(messages: DataFrame, progress: str, update: Callable[[DataFrame, int], None],
               rows: Callable[[SparkSession, int], DataFrame], table: ReportTable,
               trigger: str = REPORT_TRIGGER) -> DataStreamWriter:
    """Streaming writer over raw messages that updates a state and appends a report each ``trigger``.

    ``update`` takes the decoded events of a micro-batch, ``rows`` gives the report after it. A batch that
    fails anywhere is run again as a whole, so both must stand being repeated with the same number.
    """

    def take(batch: DataFrame, number: int) -> None:
        # Messages are read and parsed once; the state reads their events from storage as often as it needs them.
        spark, path = batch.sparkSession, scratch_path(batch.sparkSession, "decoded")
        decoded = decode_all(batch)
        try:
            decoded.write.parquet(path)
            kept = spark.read.schema(decoded.schema).parquet(path)
            total, good = kept.agg(F.count(F.lit(1)), F.count_if("good")).first()
            update(kept.filter("good").drop("good"), number)
            table.append(rows(spark, number), number, good, total - good)
        finally:
            remove(spark, path)

    return messages.writeStream.foreachBatch(take).option("checkpointLocation", progress).trigger(processingTime=trigger)


def cluster_job(messages: DataFrame, progress: str, state: ClusterTable, boroughs: Sequence[str], table: ReportTable,
                k: int = MACRO_K, trigger: str = CLUSTER_TRIGGER) -> DataStreamWriter:
    """The job that keeps micro-clusters and reports macro clusters."""
    def update(events: DataFrame, number: int) -> None:
        state.update(with_features(events, boroughs=boroughs), number)

    return report_job(messages, progress, update, lambda spark, _: cluster_rows(state, spark, k), table, trigger)

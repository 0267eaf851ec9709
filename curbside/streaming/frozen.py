"""Micro-clusters of a stream without shards, however many events a micro-batch has.

A micro-batch meets the clusters as the last one left them. Events within ``tau`` of a center are summed up by plain
partitions, a row per center and task. The others become clusters where they lie, a block of events at a time: one matrix
of distances to the open clusters, and only events that are near none go on, to be led by the first of them. A partition leaves at most
``max_micro`` clusters, and these merge ``FAN_IN`` partitions at a time. So a task's work is a partition of the input, or
``FAN_IN * max_micro`` clusters. Within a micro-batch, or a block, centers do not drift, which the purely sequential
algorithm lets them do; what is near a center then was within ``tau`` of where the center stood before, so a center is off
by less than ``tau`` times the share of its weight that the block brought.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from curbside.functions.columns import epoch_millis
from curbside.operators.decay import decay_factor
from curbside.session import remove, scratch_path
from curbside.streaming.clusters import HALF_LIFE_MINUTES, MAX_MICRO, TAU, MicroClusters

FAN_IN = 16
# Events that meet the clusters at once.
BLOCK = 1024
# Less weight than this cannot be divided by; a trillion such events together are far from a cluster that is kept.
VANISHED = 1e-200

_STATE = "clock_ms bigint, dropped double, weight array<double>, ls array<array<double>>, ss array<array<double>>"
_COLUMNS = ["part", "dropped", "weight", "ls", "ss"]
_PART = "part int, dropped double, weight double, ls array<double>, ss array<double>"


def _rows(clusters: MicroClusters, part: int) -> pd.DataFrame:
    """A row per cluster; the first one carries the weight that was dropped."""
    size = len(clusters.weight)
    return pd.DataFrame({
        "part": np.full(size, part, np.int32), "dropped": [clusters.dropped] * min(size, 1) + [0.0] * (size - 1),
        "weight": clusters.weight, "ls": clusters.ls.tolist(), "ss": clusters.ss.tolist(),
    })


def _join_all(clusters: MicroClusters, rows: pd.DataFrame, block: int = BLOCK) -> None:
    """All rows, ``block`` at a time; the number of clusters bounds the matrix of distances."""
    weight = rows["weight"].to_numpy(float)
    for at in range(0, len(rows), block):
        part = slice(at, at + block)
        ls, ss = (np.array(rows[c].iloc[part].tolist(), dtype=float) for c in ("ls", "ss"))
        clusters.join_block(weight[part], ls, ss)


def _placed(tau: float, max_micro: int, centers: np.ndarray) -> Callable:
    """Sums of the events near each of the given ``centers`` (at most ``max_micro``), and clusters of the others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        near = MicroClusters(tau, len(centers), weight=np.zeros(len(centers)), ls=np.zeros_like(centers), ss=np.zeros_like(centers))
        far = MicroClusters(tau, max_micro)
        for rows in batches:
            for at in range(0, len(rows), BLOCK):
                x = np.array(rows["features"].iloc[at : at + BLOCK].tolist(), dtype=float)
                w = rows["weight"].to_numpy(float)[at : at + BLOCK]
                ls = x * w[:, None]
                left = near.take_near(centers, x, w, ls, ls * x) if len(centers) else np.arange(len(w))
                if len(left):
                    far.join_block(w[left], ls[left], ls[left] * x[left])
        part = TaskContext.get().partitionId()
        if len(centers):
            yield _rows(near, part).assign(id=np.arange(len(centers), dtype=np.int32))[[*_COLUMNS, "id"]].query("weight > 0")
        if len(far.weight):
            yield _rows(far, part).assign(id=pd.array([None] * len(far.weight), "Int32"))[[*_COLUMNS, "id"]]

    return run


def _merge(tau: float, max_micro: int) -> Callable:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        clusters = MicroClusters(tau, max_micro, dropped=float(rows["dropped"].sum()))
        _join_all(clusters, rows.sort_values(["part", "weight"], ascending=[True, False], kind="stable"))
        return _rows(clusters, int(key[0]))

    return run


class ClusterTable:
    """The clusters after each micro-batch: one row below ``path``, of at most ``max_micro`` clusters.

    A repeated micro-batch starts from the row before it and overwrites its own.
    """

    def __init__(self, path: str, tau: float = TAU, max_micro: int = MAX_MICRO,
                 half_life_minutes: float = HALF_LIFE_MINUTES, ts: str = "pu_dt") -> None:
        self.path, self.tau, self.max_micro, self.half_life_minutes, self.ts = path, tau, max_micro, half_life_minutes, ts

    def writer(self, featured: DataFrame, progress: str) -> DataStreamWriter:
        """The stream query that keeps the table; ``featured`` has the time and ``features``."""
        return featured.writeStream.foreachBatch(self.update).option("checkpointLocation", progress)

    def _slot(self, number: int) -> str:
        return f"{self.path}/batch={number}"

    def _empty(self) -> MicroClusters:
        return MicroClusters(self.tau, self.max_micro, self.half_life_minutes * 60_000.0)

    def load(self, spark: SparkSession, number: int) -> MicroClusters:
        """The clusters as micro-batch ``number`` left them; before the first one there are none."""
        clusters = self._empty()
        row = spark.read.schema(_STATE).parquet(self._slot(number)).first() if number >= 0 else None
        if row is not None:
            clusters.clock_ms, clusters.dropped = row.clock_ms, row.dropped
            clusters.weight = np.array(row.weight, dtype=float)
            clusters.ls = np.array([list(x) for x in row.ls], dtype=float)
            clusters.ss = np.array([list(x) for x in row.ss], dtype=float)
        return clusters

    def update(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        clusters = self.load(spark, number - 1)
        centers = clusters.ls / clusters.weight[:, None] if len(clusters.weight) else np.zeros((0, 0))
        placed_path = scratch_path(spark, "placed")
        rows = batch.select("features", epoch_millis(F.col(self.ts)).alias("event_ms")).filter("event_ms IS NOT NULL")
        rows.write.parquet(placed_path)
        placed = spark.read.schema(rows.schema).parquet(placed_path)
        newest = placed.agg(F.max("event_ms")).first()[0]
        if newest is not None:
            before = clusters.clock_ms
            # A late event joins at full weight as of the clock it met.
            age = F.lit(max(newest, before)) - F.greatest("event_ms", F.lit(before))
            aged = placed.withColumn("weight", decay_factor(age, self.half_life_minutes))
            found_path = scratch_path(spark, "found")
            aged.filter(F.col("weight") > VANISHED).mapInPandas(
                _placed(self.tau, self.max_micro, centers), f"{_PART}, id int").write.parquet(found_path)
            found = spark.read.schema(f"{_PART}, id int").parquet(found_path)
            sums = self._summed(found, centers.shape[1]).collect() if len(centers) else []
            new = self._reduced(found.filter("id IS NULL").drop("id")).toPandas()
            remove(spark, found_path)
            clusters.advance_all(int(newest))
            for row in sums:
                clusters.weight[row.id] += row.weight
                clusters.ls[row.id] += np.array(row.ls)
                clusters.ss[row.id] += np.array(row.ss)
            clusters.dropped += float(new["dropped"].sum())
            clusters.forget()
            _join_all(clusters, new.sort_values(["weight", "part"], ascending=[False, True], kind="stable"))
            clusters.forget()
        state = (int(clusters.clock_ms), float(clusters.dropped), clusters.weight.tolist(), clusters.ls.tolist(), clusters.ss.tolist())
        spark.createDataFrame([state], _STATE).coalesce(1).write.mode("overwrite").parquet(self._slot(number))
        remove(spark, placed_path)

    @staticmethod
    def _summed(found: DataFrame, dims: int) -> DataFrame:
        """(id, weight, ls, ss) of the events near each center: at most ``max_micro`` rows."""
        total = lambda c: F.array(*[F.sum(F.col(c)[i]) for i in range(dims)]).alias(c)
        return found.filter("id IS NOT NULL").groupBy("id").agg(F.sum("weight").alias("weight"), total("ls"), total("ss"))

    def _reduced(self, found: DataFrame) -> DataFrame:
        """Clusters of the events far from all centers, from at most ``FAN_IN`` partitions."""
        parts = (found.agg(F.max("part")).first()[0] or 0) + 1
        while parts > FAN_IN:
            merged = found.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("part").applyInPandas(
                _merge(self.tau, self.max_micro), _PART)
            found, parts = merged, -(-parts // FAN_IN)
        return found

    def clusters(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        """(cluster, clock_ms, weight, dropped, centroid, radius, ls, ss) after a micro-batch, the newest by default."""
        states = spark.read.schema(f"{_STATE}, batch int").parquet(self.path)
        row = states.filter(F.col("batch") == (F.lit(number) if number is not None else states.agg(F.max("batch")).scalar()))
        each = row.select("clock_ms", "dropped", F.posexplode(F.arrays_zip("weight", "ls", "ss")).alias("cluster", "c"))
        each = each.select("cluster", "clock_ms", "dropped", "c.*")
        mean = each.withColumn("centroid", F.transform("ls", lambda v: v / F.col("weight")))
        total = lambda values: F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
        variance = total(F.col("ss")) / F.col("weight") - total(F.transform("centroid", lambda v: v * v))
        return mean.withColumn("radius", F.sqrt(F.greatest(variance, F.lit(0.0))))

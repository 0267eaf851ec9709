"""Decayed micro-clusters over an event stream and their weighted k-means summary."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from curbside.functions.columns import epoch_millis
from curbside.operators.decay import decay_factor
from curbside.session import checkpointed

# Defaults of the stream clustering.
MAX_MICRO = 200
TAU = 2.5
HALF_LIFE_MINUTES = 360.0
MACRO_K = 10
MACRO_ITERATIONS = 15
SEED = 42
REPORT_TRIGGER = "15 seconds"
NEGLIGIBLE = 1e-6

_STATE = "clock_ms bigint, weight array<double>, ls array<array<double>>, ss array<array<double>>"
_MICRO = (
    "shard int, cluster int, clock_ms bigint, weight double, centroid array<double>, "
    "radius double, ls array<double>, ss array<double>"
)


@dataclass
class MicroClusters:
    """Weight, linear sum and square sum of each cluster, all decayed to one clock.

    All clusters decay by the same factor, so decaying together moves no centroid. The clock only
    goes forward: a late event joins at full weight.
    """

    tau: float = TAU
    max_micro: int = MAX_MICRO
    half_life_ms: float = HALF_LIFE_MINUTES * 60_000.0
    clock_ms: int = 0
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    ls: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    ss: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    dropped: float = 0.0

    def _keep(self, kept: np.ndarray) -> None:
        self.dropped += float(self.weight[~kept].sum())
        self.weight, self.ls, self.ss = self.weight[kept], self.ls[kept], self.ss[kept]

    def advance_all(self, now_ms: int) -> None:
        """Fade every weight, also that of dropped clusters, to a later time."""
        if now_ms > self.clock_ms:
            factor = 0.5 ** ((now_ms - self.clock_ms) / self.half_life_ms)
            self.weight, self.ls, self.ss = self.weight * factor, self.ls * factor, self.ss * factor
            self.dropped *= factor
            self.clock_ms = now_ms

    def forget(self) -> None:
        """Drop what has faded."""
        alive = self.weight > NEGLIGIBLE
        if not alive.all():
            self._keep(alive)

    def advance(self, now_ms: int) -> None:
        if now_ms > self.clock_ms:
            self.advance_all(now_ms)
            self.forget()

    def join(self, weight: float, ls: np.ndarray, ss: np.ndarray) -> None:
        """A point, or a whole cluster, goes to the nearest cluster or becomes one of its own."""
        if len(self.weight):
            gaps = self.ls / self.weight[:, None] - ls / weight
            squared = np.einsum("ij,ij->i", gaps, gaps)
            nearest = int(squared.argmin())
            if squared[nearest] <= self.tau * self.tau:
                self.weight[nearest] += weight
                self.ls[nearest] += ls
                self.ss[nearest] += ss
                return
            self.weight = np.append(self.weight, weight)
            self.ls, self.ss = np.vstack([self.ls, ls]), np.vstack([self.ss, ss])
        else:
            self.weight, self.ls, self.ss = np.array([float(weight)]), ls[None, :].copy(), ss[None, :].copy()
        if len(self.weight) > self.max_micro:
            self._keep(np.arange(len(self.weight)) != self.weight.argmin())

    def take_near(self, centers: np.ndarray, points: np.ndarray, weight: np.ndarray, ls: np.ndarray, ss: np.ndarray) -> np.ndarray:
        """Points within ``tau`` of the nearest of ``centers`` go to the cluster of that number; the others are returned."""
        gaps = points[:, None, :] - centers[None, :, :]
        squared = np.einsum("ijk,ijk->ij", gaps, gaps)
        nearest = squared.argmin(axis=1)
        near = squared[np.arange(len(points)), nearest] <= self.tau * self.tau
        np.add.at(self.weight, nearest[near], weight[near])
        np.add.at(self.ls, nearest[near], ls[near])
        np.add.at(self.ss, nearest[near], ss[near])
        return np.flatnonzero(~near)

    def join_block(self, weight: np.ndarray, ls: np.ndarray, ss: np.ndarray) -> None:
        """Points or clusters at once: each goes to the nearest cluster as it was before the block.

        Those near none are led by the first of them, which takes all that are near it, until none is left. A center
        moves at most by the share of its new weight that the block brought, times ``tau``, and never beyond the
        block unseen: equal to ``join`` one by one where clusters lie farther apart than that.
        """
        points, limit = ls / weight[:, None], self.tau * self.tau
        left = np.arange(len(weight))
        if len(self.weight) and len(left):
            left = self.take_near(self.ls / self.weight[:, None], points, weight, ls, ss)
        while len(left):
            gaps = points[left] - points[left[0]]
            near = np.einsum("ij,ij->i", gaps, gaps) <= limit
            mine = left[near]
            row = (weight[mine].sum(), ls[mine].sum(axis=0), ss[mine].sum(axis=0))
            if len(self.weight):
                self.weight = np.append(self.weight, row[0])
                self.ls, self.ss = np.vstack([self.ls, row[1]]), np.vstack([self.ss, row[2]])
            else:
                self.weight, self.ls, self.ss = np.array([row[0]]), row[1][None, :], row[2][None, :]
            if len(self.weight) > self.max_micro:
                self._keep(np.arange(len(self.weight)) != self.weight.argmin())
            left = left[~near]

    def add(self, x: np.ndarray, now_ms: int) -> None:
        self.advance(now_ms)
        self.join(1.0, x, x * x)


def with_shard(events: DataFrame, shards: int, ts: str = "pu_dt", spread: str = "pu_locid") -> DataFrame:
    """Spread events evenly over shards by a hash of time and zone, so no zone makes a hot shard."""
    return events.withColumn("shard", F.pmod(F.xxhash64(ts, spread), F.lit(shards)).cast("int"))


def _updater(tau: float, max_micro: int, half_life_minutes: float) -> Callable:
    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        clusters = MicroClusters(tau, max_micro, half_life_minutes * 60_000.0)
        if state.exists:
            clock, weight, ls, ss = state.get
            clusters.clock_ms, clusters.weight = clock, np.array(weight, dtype=float)
            clusters.ls = np.array([list(row) for row in ls], dtype=float)
            clusters.ss = np.array([list(row) for row in ss], dtype=float)
        # One shard's share of one micro-batch, brought into event-time order.
        events = pd.concat(list(batches)).sort_values("event_ms", kind="stable")
        for x, now_ms in zip(np.array(events["features"].tolist(), dtype=float), events["event_ms"]):
            clusters.add(x, int(now_ms))
        state.update((clusters.clock_ms, clusters.weight.tolist(), clusters.ls.tolist(), clusters.ss.tolist()))
        weight = clusters.weight
        mean = clusters.ls / weight[:, None]
        variance = clusters.ss.sum(axis=1) / weight - (mean * mean).sum(axis=1)
        yield pd.DataFrame({
            "shard": key[0],
            "cluster": range(len(weight)),
            "clock_ms": clusters.clock_ms,
            "weight": weight,
            "centroid": mean.tolist(),
            "radius": np.sqrt(np.maximum(variance, 0.0)),
            "ls": clusters.ls.tolist(),
            "ss": clusters.ss.tolist(),
        })

    return update


def micro_clusters(events: DataFrame, tau: float = TAU, max_micro: int = MAX_MICRO,
                   half_life_minutes: float = HALF_LIFE_MINUTES, ts: str = "pu_dt") -> DataFrame:
    """Streaming micro-clusters per shard; each batch emits the current clusters of its shards.

    Input has ``shard`` and ``features``. One shard reproduces the sequential algorithm;
    several shards cluster even samples of the stream side by side, which is an approximation of
    it. Bound a micro-batch by ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger``.
    """
    rows = events.select("shard", "features", epoch_millis(F.col(ts)).alias("event_ms"))
    return rows.groupBy("shard").applyInPandasWithState(
        _updater(tau, max_micro, half_life_minutes), _MICRO, _STATE, "update", GroupStateTimeout.NoTimeout
    )


def at_common_time(micro: DataFrame, half_life_minutes: float = HALF_LIFE_MINUTES) -> DataFrame:
    """Clusters of all shards decayed to the newest clock; weights and sums then add up."""
    joined = micro.withColumn("now_ms", micro.agg(F.max("clock_ms")).scalar())
    factor = decay_factor(F.col("now_ms") - F.col("clock_ms"), half_life_minutes)
    scaled = joined.withColumn("_f", factor)
    return scaled.withColumns({
        "weight": F.col("weight") * F.col("_f"),
        "ls": F.transform("ls", lambda v: v * F.col("_f")),
        "ss": F.transform("ss", lambda v: v * F.col("_f")),
        "clock_ms": F.col("now_ms"),
    }).filter(F.col("weight") > NEGLIGIBLE).drop("_f", "now_ms")


def _squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def nearest_center(point: Column, centers: list[list[float]]) -> Column:
    """Squared distance ``d2`` and ``id`` of the nearest center; the lower id wins a tie."""
    table = F.array(*[F.array(*map(F.lit, center)) for center in centers])
    return F.array_min(F.transform(table, lambda c, i: F.struct(_squared_distance(point, c).alias("d2"), i.alias("id"))))


def _with_nearest(points: DataFrame, centers: list[list[float]]) -> DataFrame:
    """Add id and squared distance of the nearest center."""
    return points.withColumn("_best", nearest_center(F.col("centroid"), centers)).select(
        "centroid", "weight", F.col("_best.id").alias("id"), F.col("_best.d2").alias("d2")
    )


def _draw(points: DataFrame, chance: Column, seed: int, step: int) -> list[float]:
    """One point drawn with probability proportional to ``chance``, the same on every run.

    Every point gets an exponential waiting time with its chance as the rate; the first one wins.
    """
    drawn = F.pmod(F.xxhash64("centroid", "weight", F.lit(seed), F.lit(step)), F.lit(2**52))
    wait = -F.log((drawn + 1) / float(2**52 + 1)) / F.greatest(chance, F.lit(1e-300))
    return list(points.agg(F.min_by("centroid", F.struct(wait, "centroid"))).first()[0])


def macro_clusters(micro: DataFrame, k: int = MACRO_K, seed: int = SEED,
                   max_iter: int = MACRO_ITERATIONS) -> DataFrame:
    """Weighted k-means over micro-cluster centroids: (id, weight, center) per macro cluster.

    Both the k-means++ start and the means use the weights; the k-means of Spark ML starts without
    them, which costs much where a few recent clusters carry most of the weight. Each step is
    one aggregate, and only the k centers come back to the driver. The input is at most ``max_micro``
    rows per shard, whatever the stream's rate.
    """
    spark = micro.sparkSession
    points = checkpointed(micro.filter(F.col("weight") > 0).select("centroid", "weight"))
    k = min(k, points.limit(max(k, 0)).count())
    if k == 0:
        return spark.createDataFrame([], "id int, weight double, center array<double>")
    centers = [_draw(points, F.col("weight"), seed, 0)]
    while len(centers) < k:
        placed = _with_nearest(points, centers)
        centers.append(_draw(placed, F.col("weight") * F.col("d2"), seed, len(centers)))
    for iteration in range(max_iter):
        mean = Summarizer.mean(array_to_vector("centroid"), F.col("weight"))
        found = _with_nearest(points, centers).groupBy("id").agg(vector_to_array(mean).alias("center")).collect()
        moved = {row["id"]: list(row["center"]) for row in found}
        for empty in set(range(k)) - moved.keys():
            moved[empty] = _draw(points, F.lit(1.0), seed, k + iteration * k + empty)
        previous, centers = centers, [moved[i] for i in range(k)]
        if centers == previous:
            break
    weights = _with_nearest(points, centers).groupBy("id").agg(F.sum("weight").alias("weight"))
    table = spark.createDataFrame(list(enumerate(centers)), "id int, center array<double>")
    return table.join(weights, "id", "left").select("id", F.coalesce("weight", F.lit(0.0)).alias("weight"), "center")


def macro_summary(macro: DataFrame) -> DataFrame:
    """One JSON document: k and the clusters with id, weight and center."""
    clusters = F.sort_array(F.collect_list(F.struct("id", "weight", "center")))
    return macro.agg(F.count(F.lit(1)).cast("int").alias("k"), clusters.alias("clusters")).select(
        F.to_json(F.struct("k", "clusters")).alias("value")
    )


def summary_messages(macro: DataFrame, report_ms: int) -> DataFrame:
    """The summary as a message: its key is the report's time in epoch milliseconds."""
    return macro_summary(macro).select(F.lit(str(report_ms)).alias("key"), "value")


def macro_report(macro: DataFrame) -> DataFrame:
    """Centers as typed columns: share of the weight, hour of day, and the four amount features."""
    c = F.col("center")
    hour = F.pmod(F.atan2(c[0], c[1]) * (12.0 / math.pi), F.lit(24.0))
    amounts = [c[4 + i].alias(name) for i, name in enumerate(("distance", "fare", "tip", "duration"))]
    total = macro.agg(F.sum("weight")).scalar()
    return macro.select("id", "weight", (F.col("weight") / total).alias("share"), hour.alias("hour"), *amounts)

import json
import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbside.operators import decay
from curbside.plans import views
from curbside.session import scratch_path
from curbside.streaming import clusters
from curbside.streaming.replay import replay, time_slices

HALF_LIFE_MS = 360 * 60_000.0


def sequential(points, tau, max_micro):
    """One point at a time over plain dictionaries, every cluster with its own clock."""
    kept = []
    for x, now in points:
        for c in kept:
            fade = 0.5 ** (max(now - c["at"], 0) / HALF_LIFE_MS)
            c.update(w=c["w"] * fade, s=[v * fade for v in c["s"]], q=[v * fade for v in c["q"]], at=max(now, c["at"]))
        kept = [c for c in kept if c["w"] > 1e-6]
        near = min(kept, key=lambda c: math.dist(x, [v / c["w"] for v in c["s"]]), default=None)
        if near is not None and math.dist(x, [v / near["w"] for v in near["s"]]) <= tau:
            near.update(w=near["w"] + 1, s=[a + b for a, b in zip(near["s"], x)], q=[a + b * b for a, b in zip(near["q"], x)])
            continue
        kept.append({"w": 1.0, "s": list(x), "q": [v * v for v in x], "at": now})
        if len(kept) > max_micro:
            kept.remove(min(kept, key=lambda c: c["w"]))
    return kept


def featured(spark, sf):
    return decay.with_features(views.trip_events(spark, sf), boroughs=views.BOROUGHS)


def run(spark, sf, shards, tau, max_micro=200, slices=3):
    out = scratch_path(spark, "micro")
    rows = clusters.with_shard(featured(spark, sf), shards).select("shard", "features", "pu_dt")

    def start(stream, progress):
        micro = clusters.micro_clusters(stream, tau=tau, max_micro=max_micro)
        return micro.writeStream.outputMode("update").foreachBatch(
            lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}")).option("checkpointLocation", progress)

    replay(spark, time_slices(rows, "pu_dt", slices), start)
    written = spark.read.parquet(out)
    newest = written.groupBy("shard").agg(F.max("batch").alias("batch"))
    return written.join(newest, ["shard", "batch"]).drop("batch")


@pytest.mark.parametrize("tau, max_micro", [(1.0, 200), (0.6, 12)])
def test_one_shard_equals_the_sequential_algorithm(spark, sf, tau, max_micro):
    rows = featured(spark, sf).orderBy("pu_dt").select("features", "pu_dt").collect()
    points = [(r.features, (r.pu_dt - datetime(1970, 1, 1)) // timedelta(milliseconds=1)) for r in rows]
    want = sorted((c["w"], c["s"]) for c in sequential(points, tau, max_micro))
    got = sorted((r.weight, r.ls) for r in run(spark, sf, 1, tau, max_micro).collect())
    assert len(got) == len(want) > 3
    for (gw, gs), (ww, ws) in zip(got, want):
        assert gw == pytest.approx(ww, rel=1e-9) and gs == pytest.approx(ws, rel=1e-7, abs=1e-9)


def test_shards_add_up_and_are_even(spark, sf):
    micro = clusters.at_common_time(run(spark, sf, 4, 1.0))
    total = micro.agg(F.sum("weight")).first()[0]
    rows = views.trip_events(spark, sf)
    now = decay.latest_ms(rows).first().now_ms
    expected = sum(0.5 ** ((now - r.ms) / HALF_LIFE_MS) for r in rows.select(
        F.unix_millis(F.col("pu_dt").cast("timestamp")).alias("ms")).collect())
    assert total == pytest.approx(expected, rel=1e-3)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    one_zone = spark.range(4000).select((start + F.make_dt_interval(secs=F.col("id"))).alias("pu_dt"), F.lit(7).alias("pu_locid"))
    sizes = [r["count"] for r in clusters.with_shard(one_zone, 8).groupBy("shard").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_late_event_does_not_turn_the_clock_back():
    m = clusters.MicroClusters()
    m.add(np.array([0.0, 0.0]), 1_000_000)
    m.add(np.array([0.1, 0.0]), 500_000)
    assert m.clock_ms == 1_000_000 and m.weight.tolist() == [2.0]


def test_faded_clusters_are_dropped():
    m = clusters.MicroClusters(half_life_ms=1000.0)
    m.add(np.array([0.0]), 0)
    m.add(np.array([9.0]), 30_000)
    assert m.weight.tolist() == [1.0] and m.ls.tolist() == [[9.0]]


def lloyd_cost(points, weights, k, seed):
    rng = np.random.default_rng(seed)
    centers = points[rng.choice(len(points), k, replace=False, p=weights / weights.sum())]
    for _ in range(50):
        near = ((points[:, None] - centers[None]) ** 2).sum(-1).argmin(1)
        centers = np.array([np.average(points[near == j], axis=0, weights=weights[near == j]) if (near == j).any() else centers[j]
                            for j in range(k)])
    return (weights * ((points[:, None] - centers[None]) ** 2).sum(-1).min(1)).sum()


def test_macro_clusters_cost_and_summary(spark, sf):
    micro = clusters.at_common_time(run(spark, sf, 1, 0.6, slices=1))
    micro.write.mode("overwrite").parquet(path := scratch_path(spark, "fixed"))
    micro = spark.read.parquet(path)
    macro = clusters.macro_clusters(micro, k=5)
    rows = micro.collect()
    points, weights = np.array([r.centroid for r in rows]), np.array([r.weight for r in rows])
    found = macro.collect()
    centers = np.array([r.center for r in found])
    cost = (weights * ((points[:, None] - centers[None]) ** 2).sum(-1).min(1)).sum()
    assert cost <= 1.3 * min(lloyd_cost(points, weights, 5, s) for s in range(5))
    assert sum(r.weight for r in found) == pytest.approx(weights.sum())
    body = json.loads(clusters.macro_summary(macro).first().value)
    message = clusters.summary_messages(macro, 1_700_000_000_000).first()
    assert message.key == "1700000000000" and json.loads(message.value) == body
    assert body["k"] == 5 and [c["id"] for c in body["clusters"]] == list(range(5))
    assert set(body["clusters"][0]) == {"id", "weight", "center"}
    report = clusters.macro_report(macro).orderBy("id").collect()
    assert sum(r.share for r in report) == pytest.approx(1.0) and all(0 <= r.hour < 24 for r in report)
    assert [r.fare for r in report] == [r.center[5] for r in sorted(found, key=lambda r: r.id)]
    assert clusters.macro_clusters(micro.limit(1), k=5).count() == 1
    assert clusters.macro_clusters(micro.limit(0), k=5).count() == 0


def test_features_reject_missing_times_and_guard_amounts(spark):
    df = spark.createDataFrame(
        [("2024-01-01 06:30:00", 0.0, float("nan"), -1.0, float("inf"), "Queens"), (None, 1.0, 1.0, 1.0, 1.0, "EWR")],
        "t string, distance_miles double, fare_usd double, tip_usd double, duration_minutes double, pu_borough string",
    ).withColumn("pu_dt", F.col("t").cast("timestamp_ntz"))
    rows = decay.with_features(df).collect()
    assert len(rows) == 1
    x = rows[0].features
    assert len(x) == 14 and x[:4] == pytest.approx([math.sin(math.tau * 6.5 / 24), math.cos(math.tau * 6.5 / 24), 0.0, 1.0])
    assert x[4:8] == [0.0] * 4 and x[8:] == [0, 0, 1, 0, 0, 0]

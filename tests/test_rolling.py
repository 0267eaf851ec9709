import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbside.operators import rolling

T0 = datetime(2024, 1, 1)
SCHEMA = "id int, k string, ts timestamp_ntz, distance_miles double, fare_usd double, tip_usd double"


def random_events(n, seed=3, span=7200):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = T0 + timedelta(seconds=rng.choice([rng.uniform(0, span), 60 * rng.randrange(span // 60)]))
        values = [None if rng.random() < 0.3 else round(rng.uniform(0, 50), 2) for _ in range(3)]
        rows.append((i, rng.choice(["a", "a", "a", "b", None, ""]), at, *values))
    return rows


def brute(rows, seconds):
    usable = [r for r in rows if r[1] and any(v is not None for v in r[3:])]
    out = {}
    for i, k, at, *_ in usable:
        window = [r for r in usable if r[1] == k and at - timedelta(seconds=seconds) <= r[2] <= at]
        values = np.array([[v or 0.0 for v in r[3:]] for r in window])
        out[i] = (len(window), *values.mean(axis=0), *values.std(axis=0))
    return out


@pytest.mark.parametrize("seconds", [60, 900, 100_000])
def test_trailing_windows_match_brute_force(spark, seconds):
    rows = random_events(400)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {}
    for r in rolling.trailing_stats(df, "k", "ts", seconds, keep=["id"]).collect():
        got[r.id] = (r.n, *[r[f"{v}_mean"] for v in rolling.ATTRIBUTES], *[r[f"{v}_std"] for v in rolling.ATTRIBUTES])
    want = brute(rows, seconds)
    assert got.keys() == want.keys()
    for i, values in want.items():
        assert got[i] == pytest.approx(values, abs=1e-9)


def test_window_is_closed_at_both_ends(spark):
    rows = [(0, "a", T0, 1.0, 1.0, 1.0), (1, "a", T0 + timedelta(seconds=60), 3.0, 1.0, 1.0),
            (2, "a", T0 + timedelta(seconds=60, microseconds=1), 5.0, 1.0, 1.0)]
    got = {r.id: r.n for r in rolling.trailing_stats(spark.createDataFrame(rows, SCHEMA), "k", "ts", 60, keep=["id"]).collect()}
    assert got == {0: 1, 1: 2, 2: 2}


def test_one_key_is_spread_over_panes(spark):
    rows = [(i, "a", T0 + timedelta(minutes=i), 1.0, 1.0, 1.0) for i in range(200)]
    out = rolling.trailing_stats(spark.createDataFrame(rows, SCHEMA), "k", "ts", 600, keep=["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The events pass one exchange, by key and pane; the three others carry sums of panes.
    assert plan.count("Exchange hashpartitioning(k#") == 4 and "_pane#" in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert out.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_latest_window_per_key(spark):
    rows = random_events(300, seed=9)
    got = {r.k: (r.n, r.fare_usd_mean) for r in
           rolling.latest_stats(spark.createDataFrame(rows, SCHEMA).filter("k <> ''"), "k", "ts", 900).collect()}
    per_event, last = brute(rows, 900), {}
    for i, k, at, *_ in rows:
        if i in per_event and (k not in last or at > last[k][0]):
            last[k] = (at, i)
    assert got.keys() == last.keys()
    for k, (at, i) in last.items():
        assert got[k][0] == per_event[i][0] and got[k][1] == pytest.approx(per_event[i][2])


def test_a_hot_window_is_dealt_to_many_panes(spark):
    """All events in one window's time: the busiest group of the window step holds little of them."""
    from pyspark.sql import functions as F

    rows = spark.range(6400).select(
        F.lit("k").alias("k"), F.timestamp_micros(F.col("id") * 140_000).cast("timestamp_ntz").alias("pu_dt"),
        *[(F.col("id") % 97).cast("double").alias(v) for v in rolling.ATTRIBUTES])
    got = rolling.trailing_stats(rows, "k", "pu_dt", 900, keep=[]).orderBy("pu_dt").collect()
    for i in (0, 1, 63, 64, 3000, 6399):
        first = max(0, -(-(i * 140_000 - 900_000_000) // 140_000))
        window = [j % 97 for j in range(first, i + 1)]
        assert got[i]["n"] == len(window)
        assert got[i]["fare_usd_mean"] == pytest.approx(np.mean(window)) and got[i]["fare_usd_std"] == pytest.approx(np.std(window))
    pane = F.floor(F.unix_micros(F.col("pu_dt").cast("timestamp")) / (900_000_000 // rolling.BLOCKS))
    sizes = sorted(r["count"] for r in rows.groupBy(pane).count().collect())
    assert len(sizes) > 60 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("blocks", [1, 2, 64])
def test_blocks_do_not_change_the_result(spark, blocks):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(blocks)
    data = [(rng.choice("ab"), rng.randrange(0, 4000), rng.random() * 9) for _ in range(600)]
    rows = spark.createDataFrame(data, "k string, s long, x double").select(
        "k", F.timestamp_seconds("s").cast("timestamp_ntz").alias("t"), "s", "x")
    got = rolling.trailing_stats(rows, "k", "t", 300, ["x"], keep=["s"], blocks=blocks).collect()
    assert len(got) == 600
    for r in got:
        window = [x for k, s, x in data if k == r["k"] and r["s"] - 300 <= s <= r["s"]]
        assert r["n"] == len(window) and r["x_mean"] == pytest.approx(np.mean(window))
        assert r["x_std"] == pytest.approx(np.std(window), abs=1e-7)

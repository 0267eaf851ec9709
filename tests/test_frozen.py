import numpy as np
import pytest
from pyspark.sql import functions as F

from curbside.session import scratch_path
from curbside.streaming.clusters import MicroClusters
from curbside.streaming.frozen import ClusterTable

HOUR_MS = 3_600_000
START = "2024-01-01 00:00:00"


def start():
    return F.lit(START).cast("timestamp_ntz")


def around(spark, centers, n, hours, partitions):
    """Points on a small ring around each center, a time in ``hours`` each."""
    table = F.array(*[F.array(*map(F.lit, c)) for c in centers])
    at = F.element_at(table, (F.col("id") % len(centers)).cast("int") + 1)
    turn = F.col("id") * 0.37
    hour = F.lit(hours[0]) + F.floor(F.col("id") * (hours[1] - hours[0]) / n)
    return spark.range(0, n, 1, partitions).select(
        F.array(at[0] + F.cos(turn) * 0.1, at[1] + F.sin(turn) * 0.1).alias("features"),
        (start() + F.make_dt_interval(hours=hour.cast("int"))).alias("pu_dt"))


def expected(batches):
    """Faded weights and sums per center, in numpy."""
    rows = [r for b in batches for r in b.collect()]
    x = np.array([r.features for r in rows])
    ms = np.array([r.pu_dt.timestamp() * 1000 for r in rows])
    weight = 0.5 ** ((ms.max() - ms) / (6 * HOUR_MS))
    label = np.round(x / 10).astype(int)
    return {tuple(k): (weight[m].sum(), (weight[m, None] * x[m]).sum(0)) for k in np.unique(label, axis=0)
            for m in [(label == k).all(1)]}


def found(table, spark):
    return {tuple(round(v / 10) for v in r.centroid): (r.weight, np.array(r.ls)) for r in table.clusters(spark).collect()}


@pytest.mark.parametrize("partitions", [3, 40])
def test_separated_clusters_are_exact_over_batches_and_repeats(spark, partitions):
    table = ClusterTable(scratch_path(spark, "table"), tau=3.0)
    first = around(spark, [[0.0, 0.0], [10.0, 0.0], [0.0, 20.0]], 300, (0, 10), partitions)
    second = around(spark, [[0.0, 0.0], [30.0, 30.0]], 200, (10, 20), partitions)
    table.update(first, 0)
    table.update(second, 1)
    want = expected([first, second])
    for _ in range(2):
        got = found(table, spark)
        assert got.keys() == want.keys()
        for key, (weight, ls) in want.items():
            assert got[key][0] == pytest.approx(weight) and got[key][1] == pytest.approx(ls, abs=1e-9)
        table.update(second, 1)
    assert table.clusters(spark, 0).count() == 3


def test_weight_above_the_bound_is_reported(spark):
    table = ClusterTable(scratch_path(spark, "table"), tau=3.0, max_micro=4)
    rows = around(spark, [[10.0 * i, 0.0] for i in range(12)], 240, (0, 1), 40)
    table.update(rows, 0)
    got = table.clusters(spark).collect()
    assert len(got) == 4 and got[0].dropped > 0
    assert sum(r.weight for r in got) + got[0].dropped == pytest.approx(240)


def test_empty_batches_late_events_and_missing_times(spark):
    table = ClusterTable(scratch_path(spark, "table"), tau=3.0)
    rows = around(spark, [[0.0, 0.0]], 10, (5, 6), 2)
    table.update(rows.limit(0), 0)
    assert table.clusters(spark).count() == 0
    table.update(rows, 1)
    late = rows.select("features", (start() - F.make_dt_interval(days=F.lit(400))).alias("pu_dt"))
    table.update(late.unionByName(rows.withColumn("pu_dt", F.lit(None).cast("timestamp_ntz"))), 2)
    row = table.clusters(spark).first()
    assert row.weight == pytest.approx(20.0)
    table.update(rows.limit(0), 3)
    assert table.clusters(spark).first().weight == pytest.approx(20.0)


@pytest.mark.parametrize("block", [1, 7, 64, 1000])
def test_blocks_equal_the_sequential_form_on_separated_points(block):
    rng = np.random.default_rng(block)
    centers = np.arange(12)[:, None] * np.array([20.0, -15.0, 5.0])
    x = centers[rng.integers(0, 12, 800)] + rng.uniform(-0.5, 0.5, (800, 3))
    w = rng.uniform(0.1, 3.0, 800)
    one, many = MicroClusters(3.0, 50), MicroClusters(3.0, 50)
    for p, v in zip(x, w):
        one.join(float(v), p * v, p * p * v)
    for at in range(0, 800, block):
        part = slice(at, at + block)
        many.join_block(w[part], x[part] * w[part, None], x[part] ** 2 * w[part, None])
    order = lambda c: np.argsort((c.ls / c.weight[:, None])[:, 0])
    for name in ("weight", "ls", "ss"):
        assert np.allclose(getattr(one, name)[order(one)], getattr(many, name)[order(many)])


def test_blocks_keep_all_weight_when_events_have_nothing_in_common():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1e6, 1e6, (3000, 4))
    clusters = MicroClusters(2.5, 200)
    for at in range(0, 3000, 1000):
        clusters.join_block(np.ones(1000), x[at : at + 1000], x[at : at + 1000] ** 2)
    assert len(clusters.weight) == 200 and clusters.weight.sum() + clusters.dropped == pytest.approx(3000)


def test_centers_are_off_by_no_more_than_the_stated_error():
    """Every point that joins lies within tau of where the center was before its block."""
    rng = np.random.default_rng(2)
    clusters, block = MicroClusters(2.5, 200), 500
    clusters.join_block(np.ones(block), *(lambda v: (v, v * v))(rng.normal(0, 0.5, (block, 2))))
    before, held = clusters.ls / clusters.weight[:, None], clusters.weight.copy()
    clusters.join_block(np.ones(block), *(lambda v: (v, v * v))(rng.normal(0, 0.5, (block, 2))))
    moved = np.linalg.norm(clusters.ls[: len(held)] / clusters.weight[: len(held), None] - before, axis=1)
    brought = 1 - held / clusters.weight[: len(held)]
    assert (moved <= 2.5 * brought + 1e-12).all()

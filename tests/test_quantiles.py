import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbside.operators import colstats, money, quantiles as q


def shapes():
    rng = random.Random(1)
    yield "ties", [rng.choice([1.0, 1.0, 1.0, 2.0, 3.0]) for _ in range(3000)]
    yield "skewed", [rng.lognormvariate(0, 3) for _ in range(20_000)]
    yield "sorted", [float(i) for i in range(15_000)]
    for n in range(1, 25):
        yield f"n{n}", [rng.random() for _ in range(n)]


def table(spark, parts=5):
    rows = [(name, v) for name, values in shapes() for v in values] + [("n3", None), ("nulls", None)]
    return spark.createDataFrame(rows, "g string, v double").repartition(parts)


@pytest.mark.parametrize("accuracy", [50, 1000])
def test_exact_quantiles_equal_numpy(spark, accuracy):
    wanted = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = {r.g: r.quantiles for r in q.exact_quantiles(table(spark), ["g"], "v", wanted, accuracy).collect()}
    for name, values in shapes():
        assert got[name] == pytest.approx(list(np.quantile(values, wanted)), rel=1e-12), name
    assert got["nulls"] is None


def test_narrowing_passes_equal_numpy(spark, capsys):
    """A bound far below what a bracket holds makes several passes, with nothing ordered beyond it."""
    rng = np.random.default_rng(4)
    shapes_ = {"even": rng.random(30_000), "heavy": np.where(rng.random(30_000) < 0.4, 0.5, rng.random(30_000)), "few": rng.integers(0, 5, 5000) * 1.0}
    rows = spark.createDataFrame([(g, float(v)) for g, vs in shapes_.items() for v in vs], "g string, v double").repartition(6)
    wanted = [0.1, 0.5, 0.55, 0.99]
    found = q.exact_quantiles(rows, ["g"], "v", wanted, accuracy=20, bound=26)
    for r in found.collect():
        assert r.quantiles == pytest.approx(list(np.quantile(shapes_[r.g], wanted)), rel=1e-12), r.g
    found.explain("formatted")
    assert "Window" not in capsys.readouterr().out


def test_summary_is_small(spark):
    rows = table(spark).filter("g = 'sorted'")
    brackets = q.quantile_brackets(rows, ["g"], "v", [0.5], 1000)
    assert q.rank_summary(rows, ["g"], "v", brackets, 1).count() < 15_000 * 0.02


def test_describe_moments(spark):
    rows = table(spark)
    brackets = q.quantile_brackets(rows, ["g"], "v", [0.5], 100)
    got = {r.g: r for r in q.describe(q.rank_summary(rows, ["g"], "v", brackets, 1), ["g"], [0.5]).collect()}
    for name, values in shapes():
        r = got[name]
        assert (r.n, r.min, r.max) == (len(values), min(values), max(values))
        assert r["mean"] == pytest.approx(np.mean(values), rel=1e-12)
        if len(values) > 1:
            assert r["std"] == pytest.approx(np.std(values, ddof=1), rel=1e-9)
        else:
            assert r["std"] is None
    assert got["n3"].nulls == 1 and got["nulls"].n == 0 and got["nulls"].nulls == 1


def test_wrong_bracket_fails_instead_of_guessing(spark):
    rows = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("v"))
    wrong = spark.createDataFrame([("a", [10.0, 20.0])], "g string, _cuts array<double>")
    # The median of 1,000 is far above the bracket.
    with pytest.raises(Exception, match="outside its bracket"):
        q.describe(q.rank_summary(rows, ["g"], "v", wrong, 1), ["g"], [0.5]).collect()


def test_approximations_stay_within_their_rank_error(spark):
    rows = table(spark).filter("g in ('skewed', 'ties', 'sorted')")
    found = rows.groupBy("g").agg(q.approx_quantile(F.col("v"), 0.9, 1000).alias("e"))
    assert all(r.rank_error <= 0.002 for r in q.rank_error(rows, ["g"], "v", found, 0.9, "e").collect())
    parts = q.sketches(rows.withColumn("part", F.floor(F.rand(3) * 5)), ["g", "part"], "v")
    merged = q.merge_sketches(parts, ["g"]).select("g", q.sketch_quantile("sketch", 0.9).alias("e"))
    assert all(r.rank_error <= 0.02 for r in q.rank_error(rows, ["g"], "v", merged, 0.9, "e").collect())


def test_quantile_arguments():
    with pytest.raises(ValueError):
        q.approx_quantile(F.lit(1), [])


def test_colstats_approx_agrees_with_exact(spark, sf):
    from curbside.operators.clean import with_trip_time
    from curbside.plans import views

    trips = with_trip_time(views.trips(spark, sf))
    exact = {(r.dataset, r.col): r for r in colstats.colstats(trips).collect()}
    approx = {(r.dataset, r.col): r for r in colstats.colstats_approx(trips).collect()}
    assert exact.keys() == approx.keys() and len(exact) == 17
    for key, e in exact.items():
        a = approx[key]
        assert a["mean"] == pytest.approx(e["mean"]) and a["std"] == pytest.approx(e["std"])
        assert a.q50 == pytest.approx(e.q50, rel=0.02)


def test_tip_curve_drops_tips_at_the_limit(spark):
    rows = [("x", 12.0, 1.0)] * 95 + [("x", 18.0, 9.0)] * 5 + [(None, 12.0, 1.0), ("x", 1000.0, 1.0), ("x", None, 1.0)]
    df = spark.createDataFrame(rows, "label string, fee_fare double, fee_tip double")
    got = [tuple(r) for r in money.fare_tip_curve(df).collect()]
    values = [1.0] * 95 + [9.0] * 5
    limit = np.quantile(values, 0.95)
    kept = [v for v in values if v < limit]
    assert got == [("x", 15, pytest.approx(np.mean(kept)), len(kept))]


def test_sketch_table_adds_new_units_alone(spark):
    from curbside.session import scratch_path

    rows = spark.range(30_000).select(
        F.lit("a").alias("g"), F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string")).alias("month"),
        F.col("id").cast("double").alias("v"))
    table = q.SketchTable(scratch_path(spark, "sketches"), ["g"], "month", "v")
    table.update(rows.filter("month < '2024-03'"))
    files = {r.f for r in spark.read.parquet(table.path).select(F.input_file_name().alias("f")).collect()}
    # Were the old months read into sketches again, these changed values would show.
    table.update(rows.withColumn("v", F.when(F.col("month") < "2024-03", -1.0).otherwise(F.col("v"))))
    after = {r.f for r in spark.read.parquet(table.path).select(F.input_file_name().alias("f")).collect()}
    assert files < after
    found = table.merged(spark, ["g"]).select("g", "n", q.sketch_quantile("sketch", 0.5).alias("e")).first()
    assert found.n == 30_000 and found.e == pytest.approx(15_000, rel=0.03)

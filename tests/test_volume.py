from datetime import datetime

import pytest
from pyspark.sql import functions as F

from curbside.operators import bases, money, volume, zones as zone_ops


def hours(spark, rows):
    return spark.createDataFrame([(datetime.fromisoformat(h), l, v) for h, l, v in rows],
                                 "hour timestamp_ntz, label string, volume long")


def test_period_counts_skip_missing_keys(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 31, 23, 59), "a"), (datetime(2024, 1, 1), "a"), (None, "a"), (datetime(2024, 1, 1), None)],
        "pu_dt timestamp_ntz, label string")
    assert [tuple(r) for r in volume.rides_by_period(df, "month", "label").collect()] == [(datetime(2024, 1, 1), "a", 2)]
    got = {r.hour for r in volume.rides_by_period(df, "hour", "label").collect()}
    assert got == {datetime(2024, 1, 31, 23), datetime(2024, 1, 1)}


def test_day_profile_divides_by_days_seen(spark):
    df = hours(spark, [("2024-01-01T05:00", "a", 3), ("2024-01-01T06:00", "b", 1), ("2024-01-02T05:00", "a", 2)])
    got = {(r.hour, r.label): r.volume for r in volume.day_profile(df).collect()}
    assert got == {(5, "a"): pytest.approx((0.75 + 1) / 2), (6, "b"): pytest.approx(0.25 / 2)}


def test_week_runs_tuesday_to_monday(spark):
    df = hours(spark, [("2024-01-08T05:00", "a", 1), ("2024-01-09T05:00", "a", 1), ("2024-01-15T01:00", "a", 3)])
    got = {r.weekday: r.volume for r in volume.week_profile(df).collect()}
    assert got == {0: pytest.approx((1 + 0.75) / 2), 1: pytest.approx(0.25 / 2)}
    monday = {r.weekday: r.volume for r in volume.week_profile(df, first_weekday=0).collect()}
    assert monday == {0: pytest.approx((0.5 + 1) / 2), 1: pytest.approx(0.5 / 2)}


def test_split_counts_periods_per_side(spark):
    df = hours(spark, [("2020-03-31T23:00", "a", 1), ("2020-04-01T00:00", "a", 1), ("2020-04-02T00:00", "a", 5)])
    got = {(r.side, r.hour): r.volume for r in volume.day_profile(volume.with_side(df), side=["side"]).collect()}
    assert got == {("before", 23): 1.0, ("after", 0): 1.0}


def test_share_fills_missing_labels_with_zero(spark):
    df = hours(spark, [("2024-01-01T00:00", "yellow", 3), ("2024-01-01T00:00", "green", 1)]).withColumnRenamed("hour", "month")
    got = {r.label: r.share for r in volume.volume_share(df, "month", "label", volume.LABELS).collect()}
    assert got == {"yellow": 0.75, "green": 0.25, "fhv_small": 0.0, "fhv_big": 0.0}


def test_loops_count_twice_in_the_zone_ranking(spark):
    arcs = spark.createDataFrame([(1, 1, 5), (1, 2, 1), (3, 2, 10)], "pu_locid int, do_locid int, n long")
    top = volume.top_zones(arcs, 2)
    assert [(r.locid, r.n, r["rank"]) for r in top.orderBy("rank").collect()] == [(1, 11, 1), (2, 11, 2)]
    wide = volume.arc_matrix_wide(volume.arc_matrix(arcs, top), 2).orderBy("pu_rank").collect()
    assert [(r.pu_locid, r.to_1, r.to_2) for r in wide] == [(1, pytest.approx(0.69897, abs=1e-5), 0.0)]


def test_payment_and_distance(spark):
    df = spark.createDataFrame([("yellow", None), ("yellow", 5), ("yellow", 1)], "label string, payment_type int")
    got = {(r.payment_type, r.payment_name): r.n for r in money.payment_types(df).collect()}
    assert got == {(5, "Unknown"): 2, (1, "Card"): 1}
    df = spark.createDataFrame([(1.0, 4.0), (1.01, None), (None, 9.0)], "distance double, fee_fare double")
    assert [tuple(r) for r in money.distance_fare_curve(df).collect()] == [(0, 4.0, 2, 1.0)]


def test_duration_bins_at_sixty_seconds(spark):
    rows = [(datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1)), (datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1, 1)),
            (datetime(2024, 1, 1), datetime(2024, 1, 1)), (datetime(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "pu_dt timestamp_ntz, do_dt timestamp_ntz").withColumn("label", F.lit("x"))
    assert {r.time: r.n for r in money.trip_time_bins(df).collect()} == {"0-60s": 1, "1-5min": 1}


def test_big_set_wins_and_null_license_is_small(spark):
    last = spark.createDataFrame([("B1",), ("B2",), ("B3",), ("B4",)], "dbn string").withColumn("ls", F.lit(1))
    pairs = spark.createDataFrame([("B1", "HV0003"), ("B1", "HV0002"), ("B2", None), ("B9", "HV0005"), ("B3", "HV0004")],
                                  "dbn string, ln string")
    sets = {(r.operator, r.dbn) for r in bases.base_sets(bases.base_breakdown(last, pairs)).collect()}
    assert sets == {("big", "B1"), ("small", "B1"), ("small", "B2"), ("small", "B3")}
    big = spark.createDataFrame([("B1",)], "dbn string")
    fhv = spark.createDataFrame([("B1",), ("B2",), (None,)], "dbasenum string")
    assert [r.label for r in bases.label_fhv(fhv, big).orderBy("dbasenum").collect()] == [None, "fhv_big", "fhv_small"]
    app = spark.createDataFrame([("HV0003",), ("HV0002",), (None,)], "licensenum string")
    assert [r.label for r in bases.label_fhvhv(app).orderBy("licensenum").collect()] == [None, "fhv_small", "fhv_big"]


def test_stacked_labels_equal_per_feed_labels(spark, sf):
    from curbside.plans import registry, views

    big = registry._big_bases(spark, sf)
    trips = views.trips(spark, sf)
    want = {}
    for frame in (bases.label_fhv(views.feed(trips, "fhv"), big), bases.label_fhvhv(views.feed(trips, "fhvhv"))):
        want |= {(r.dataset, r.label): r["count"] for r in frame.groupBy("dataset", "label").count().collect()}
    got = {(r.dataset, r.label): r["count"] for r in
           bases.label_stacked(trips, big).groupBy("dataset", "label").count().collect()}
    assert {k: v for k, v in got.items() if k[0].startswith("fhv")} == want


def test_last_seen_day_and_null_text(spark):
    rows = [("b1", datetime(2019, 1, 31, 23)), ("B1", datetime(2019, 1, 2)), ("b2", datetime(2019, 2, 1)), (None, datetime(2019, 1, 31))]
    df = spark.createDataFrame(rows, "dbasenum string, pu_dt timestamp_ntz")
    assert [r.dbn for r in bases.base_last_seen(df).collect()] == ["B1"]
    pairs = spark.createDataFrame([("NULL", "x"), ("null", "x"), ("Null", "y"), (None, "x"), ("b", "x"), ("B", "x")], "dbasenum string, licensenum string")
    assert [tuple(r) for r in bases.base_license_pairs(pairs).collect()] == [("B", "x")]


def test_joins_with_zones(spark):
    zones = spark.createDataFrame([(1, "z1", "Q"), (2, "z2", "K")], "locid int, zone string, borough string")
    df = spark.createDataFrame([(1,), (9,), (None,)], "locid int")
    assert {(r.locid, r.zone) for r in zone_ops.join_zone_names(df, zones).collect()} == {(1, "z1"), (9, None), (None, None)}
    assert zone_ops.zones_right_join(df, zones).count() == 3
    assert [(r.position, r.locid, r.zone) for r in zone_ops.resolve_ids(spark, [2, 7, 1], zones).collect()] == [
        (0, 2, "z2"), (1, 7, None), (2, 1, "z1")]
    trips = spark.createDataFrame([(1, 2)] * 9, "pu_locid int, do_locid int")
    assert {tuple(r) for r in zone_ops.borough_sample(trips, zones).collect()} == {(1, 2, "Q", "K")}
    assert zone_ops.borough_sample(trips, zones).count() == 5
    ids = spark.createDataFrame([(1,)], "id int")
    assert [r.locid for r in zone_ops.keep_ids(df, ids, "locid").collect()] == [1]
    assert sorted((r.locid for r in zone_ops.drop_ids(df, ids, "locid").collect()), key=str) == [9, None]


def test_large_side_is_not_broadcast(spark):
    from curbside.session import small_side

    big, small = spark.range(50), spark.range(5)
    fact = spark.range(100).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for side, limit, expected in ((small, 10, True), (big, 10, False)):
            plan = fact.join(small_side(side, limit), F.col("k") == F.col("id"))._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan) is expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_go_around_a_large_lookup(spark):
    from curbside.session import lookup

    df = spark.createDataFrame([(1, "a"), (9, "b"), (None, "c")], "k int, v string")
    side = spark.createDataFrame([(1, "x"), (2, "y")], "k int, name string")
    want = {("a", "x"), ("b", None), ("c", None)}
    for bound in (10, 1):
        assert {(r.v, r.name) for r in lookup(df, side, "k", bound).collect()} == want
    assert "Union" in lookup(df, side, "k", 1)._jdf.queryExecution().executedPlan().toString()


def test_a_few_long_rows_are_not_small(spark):
    from curbside.session import is_small

    rows = spark.range(10).select("id", F.expr("repeat('é', 100)").alias("odd `name`"), F.array("id").alias("list"))
    assert is_small(rows) and is_small(rows.limit(0))
    assert not is_small(rows, max_rows=9)
    assert is_small(rows, max_bytes=4_000) and not is_small(rows, max_bytes=2_000)

from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from curbside.operators import anomaly, clean
from curbside.plans import views
from curbside.sources import feeds

T0 = datetime(2024, 1, 1, 12)


def test_zone_range_is_one_to_263(spark):
    df = spark.createDataFrame([(0, 264), (1, 263), (None, 5)], "pu_locid int, do_locid int")
    assert [tuple(r) for r in clean.clean_zones(df).collect()] == [(None, None), (1, 263), (None, 5)]


def test_dropoff_limits(spark):
    ends = [T0, T0 - timedelta(seconds=1), T0 + timedelta(days=30), T0 + timedelta(days=30, microseconds=1), None]
    df = spark.createDataFrame([(T0, e) for e in ends], "pu_dt timestamp_ntz, do_dt timestamp_ntz")
    assert [r.do_dt for r in clean.clean_dropoff(df).collect()] == [None, None, ends[2], None, None]


def test_amounts_only_touch_present_columns(spark):
    df = spark.createDataFrame([(0, 0.0, -1.0), (2, -1.0, 0.0)], "passengers int, distance double, fee_fare double")
    assert [tuple(r) for r in clean.clean_amounts(df).collect()] == [(None, None, None), (2, None, 0.0)]


def test_base_numbers(spark):
    df = spark.createDataFrame([("b1",), ("null",), (None,)], "dbasenum string")
    assert [r.dbasenum for r in clean.clean_base(df).collect()] == ["B1", None, None]


def test_feed_kind_by_marker_column():
    assert feeds.feed_kind(["tpep_pickup_datetime"]) == "yellow"
    assert feeds.feed_kind(["lpep_pickup_datetime"]) == "green"
    assert feeds.feed_kind(["hvfhs_license_num", "pickup_datetime"]) == "fhvhv"
    assert feeds.feed_kind(["pickup_datetime"]) == "fhv"


@pytest.mark.parametrize("name", feeds.FEEDS)
def test_universal_columns_cover_the_feed(spark, sf, name):
    raw = views.raw_feed(spark, sf, name)
    assert feeds.feed_kind(raw.columns) == name
    known = set(clean.RENAMES[name]) | set(clean.EXTRAS[name]) | {"year"}
    assert known == {f.name for f in feeds.feed_schema(name).fields}
    out = clean.universal_trips(raw)
    assert {"pu_dt", "do_dt", "pu_locid", "do_locid"} <= set(out.columns)
    assert out.count() == raw.count()


def test_conform_ignores_case_and_adds_year(spark):
    df = spark.createDataFrame([(T0, 3.0, 7)], "Pickup_DateTime timestamp_ntz, PULocationID double, other int")
    schema = T.StructType.fromDDL("pulocationid int, pickup_datetime timestamp_ntz, year int")
    out = clean.conform(df, schema, "pickup_datetime")
    assert out.schema == schema or [f.dataType for f in out.schema] == [f.dataType for f in schema]
    assert tuple(out.first()) == (3, T0, 2024)
    with pytest.raises(ValueError, match="missing"):
        clean.conform(df, T.StructType.fromDDL("dolocationid int"), "pickup_datetime")


def audit(spark, rows):
    schema = ("src_year int, pu timestamp_ntz, do timestamp_ntz, a int, b int, dist double, fare double")
    df = spark.createDataFrame(rows, schema)
    return df, anomaly.anomaly_flags("src_year", "pu", "do", "a", "b", "dist", "fare")


def test_anomaly_edges(spark):
    day = timedelta(days=1)
    df, flags = audit(spark, [
        (2024, T0, T0, 1, 263, 0.0, 1000.0),
        (2024, T0, T0 + 14 * day, None, None, None, None),
        (2024, T0, T0 + 14 * day + timedelta(microseconds=1), 0, 5, -1.0, 1000.5),
        (2023, T0, T0 - day, 5, 264, 1.0, -0.5),
    ])
    got = {r.src_year: r.asDict() for r in anomaly.count_anomalies(df, flags).collect()}
    assert got[2024] == dict(src_year=2024, rows=3, year_out_of_range=0, time_zero=1, time_negative=0, time_very_high=1,
                             location_invalid=1, distance_zero=1, distance_negative=1, fare_very_high=1, fare_negative=0)
    assert got[2023]["year_out_of_range"] == got[2023]["time_negative"] == got[2023]["location_invalid"] == 1


def test_zone_errors_count_both_ends_from_their_own_columns(spark):
    df, flags = audit(spark, [(2024, T0, T0, 5, 6, None, None), (2024, T0, T0 + timedelta(hours=1), 5, 5, None, None)])
    ends = anomaly.flagged_zone_ends(df, "x", flags, "a", "b")
    got = {r.locid: (r["rows"], r.errors) for r in anomaly.anomalies_by_zone(ends).collect()}
    assert got == {5: (3, 1), 6: (1, 1)}


def test_top_zones_break_ties_by_id(spark):
    df = spark.createDataFrame([("x", 9, 10, 5), ("x", 2, 2, 1), ("x", 4, 4, 1)], "label string, locid int, rows long, errors long")
    top = anomaly.top_zones_by_rate(anomaly.zone_error_rate(df), 2)
    assert [(r.locid, r["rank"]) for r in top.orderBy("rank").collect()] == [(2, 1), (9, 2)]

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from curbside.operators import rolling
from curbside.plans import views
from curbside.sinks.kafka import PRODUCER
from curbside.streaming import events
from curbside.streaming.replay import replay, time_slices
from curbside.streaming.rolling import RollingReport, sliding_stats


def test_event_json_has_all_fields_and_explicit_nulls(spark, sf):
    row = events.encode_events(views.trip_events(spark, sf).filter("event_id = 13")).first()
    body = json.loads(row.value)
    assert tuple(body) == events.EVENT_FIELDS
    assert body["distance_miles"] is None and " " not in row.value.split('"pu_borough"')[0]
    assert row.key == str(body["pu_locid"])
    at = datetime.fromisoformat(body["pu_dt"])
    assert row.event_ms == (at - datetime(1970, 1, 1)) // timedelta(milliseconds=1)


def test_key_falls_back_to_the_dataset_and_nan_becomes_null(spark):
    zones = spark.createDataFrame([(5, "z", "Queens")], "locid int, zone string, borough string")
    t = datetime(2024, 5, 1, 8)
    trips = spark.createDataFrame([("yellow", t, t + timedelta(seconds=90), None, 5.0, float("nan"), 1.0, 0.0)],
                                  "dataset string, pu_dt timestamp_ntz, do_dt timestamp_ntz, pu_locid double, do_locid double, "
                                  "distance_miles double, fare_usd double, tip_usd double")
    row = events.encode_events(events.build_events(trips, zones)).first()
    body = json.loads(row.value)
    assert row.key == "yellow" and body["distance_miles"] is None and body["duration_minutes"] == 1.5
    assert (body["pu_borough"], body["do_borough"], body["do_locid"]) == (None, "Queens", 5)


def test_bad_messages_are_skipped_and_float_ids_become_integers(spark):
    good = {f: None for f in events.EVENT_FIELDS} | {"pu_dt": "2024-01-01T00:00:00", "pu_locid": 132.0}
    df = spark.createDataFrame([(json.dumps(good),), ("{broken",), (None,)], "value string")
    rows = events.decode_events(df).collect()
    assert [(r.pu_locid, r.pu_dt) for r in rows] == [(132, datetime(2024, 1, 1))]


def test_a_wrong_field_costs_only_itself(spark):
    values = ['{"fare_usd":"12.5","pu_locid":"7"}', '{"pu_locid":"n/a","tip_usd":1}', '{"fare_usd":"NaN","do_locid":3.0,"pu_dt":"x"}']
    rows = events.decode_events(spark.createDataFrame([(v,) for v in values], "value string")).collect()
    assert [(r.fare_usd, r.pu_locid, r.do_locid, r.tip_usd, r.pu_dt) for r in rows] == [
        (12.5, 7, None, None, None), (None, None, None, 1.0, None), (None, None, 3, None, None)]


def test_year_filter_and_source_columns(spark):
    t = [datetime(2023, 12, 31, 23, 59), datetime(2024, 1, 1), datetime(2024, 12, 31), datetime(2025, 1, 1)]
    raw = spark.createDataFrame([(a, a, 1, 2, 1.0, 2.0, 3.0) for a in t],
                                "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, PULocationID int, "
                                "DOLocationID int, trip_miles double, base_passenger_fare double, tips double")
    assert [r.pu_dt for r in events.select_event_trips(raw, "fhvhv", 2024).orderBy("pu_dt").collect()] == t[1:3]


def test_topics_and_replay_order(spark, sf):
    assert events.topic_name("yellow", 2024) == "yellow_trips_2024"
    assert events.topic_name("yellow", 2024, "t") == "t"
    assert PRODUCER["kafka.acks"] == "all"
    ordered = events.in_pickup_order(views.event_trips(spark, sf), 4)
    rows = ordered.select(F.spark_partition_id().alias("p"), "pu_dt").collect()
    assert [r.pu_dt for r in rows] == sorted(r.pu_dt for r in rows) and len({r.p for r in rows}) > 1


def test_slices_cover_every_event_once(spark, sf):
    rows = views.event_trips(spark, sf)
    parts = time_slices(rows, "pu_dt", 3)
    assert sum(p.count() for p in parts) == rows.count()
    assert len(time_slices(rows, "pu_dt", 1)) == 1


@pytest.fixture(scope="module")
def messages(spark, sf):
    return views.trip_events(spark, sf)


@pytest.mark.parametrize("slices", [1, 3])
def test_report_after_restarts_equals_batch(spark, messages, tmp_path, slices):
    report = RollingReport(str(tmp_path / "r"), 6 * 3600, top_n=3)
    parts = [events.encode_events(p) for p in time_slices(messages, "pu_dt", slices)]
    replay(spark, parts, lambda s, progress: report.writer(events.decode_events(s), progress))
    batch = report.last_batch(spark)
    assert batch == slices - 1
    got = {r.pu_borough: r.asDict() for r in report.boroughs(spark, batch).collect()}
    want = {r.pu_borough: r.asDict() for r in rolling.latest_stats(messages, "pu_borough", "pu_dt", 6 * 3600).collect()}
    assert got.keys() == want.keys()
    for key, w in want.items():
        for name, value in w.items():
            assert got[key][name] == (pytest.approx(value) if isinstance(value, float) else value)
    counts = messages.groupBy("pu_locid").count().orderBy(F.col("count").desc(), "pu_locid").limit(3)
    assert [(r.pu_locid, r.seen) for r in report.top_zones(spark, batch).orderBy(F.col("seen").desc(), "pu_locid").collect()] == [
        tuple(r) for r in counts.collect()]


def test_repeated_batch_gives_the_same_state(spark, messages, tmp_path):
    report = RollingReport(str(tmp_path / "r"), 6 * 3600)
    first, second = time_slices(messages, "pu_dt", 2)
    report.update(first, 0)
    report.update(second, 1)
    once = sorted(map(tuple, report.boroughs(spark, 1).select("pu_borough", "n", "last_ts").collect()))
    report.update(second, 1)
    assert sorted(map(tuple, report.boroughs(spark, 1).select("pu_borough", "n", "last_ts").collect())) == once


def test_older_reports_keep_their_counts(spark, tmp_path):
    report = RollingReport(str(tmp_path / "r"), 3600, top_n=5, keep=4)
    schema = "pu_dt timestamp_ntz, pu_borough string, pu_locid int, distance_miles double, fare_usd double, tip_usd double"
    for batch in range(5):
        rows = [(datetime(2024, 1, 1, batch, i), "Queens", zone, 1.0, 2.0, 3.0) for i in range(2 + batch) for zone in (6, batch + 10)]
        report.update(spark.createDataFrame(rows, schema), batch)
        first = sorted((r.pu_locid, r.seen, r.n) for r in report.top_zones(spark, max(batch - 3, 0)).collect())
        if batch < 4:
            assert first == [(6, 2, 2), (10, 2, 2)]
    assert first == [(6, 5, 3), (10, 2, 2), (11, 3, 3)]
    assert not (tmp_path / "r" / "report" / "batch=0").exists()


def test_sliding_windows_drop_nothing_in_order(spark, messages, tmp_path):
    out = str(tmp_path / "w")

    def start(stream, progress):
        windows = sliding_stats(events.decode_events(stream), "pu_borough", window="2 hours", slide="1 hour", watermark="1 hour")
        return windows.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)

    replay(spark, [events.encode_events(p) for p in time_slices(messages, "pu_dt", 2)], start)
    got = {(r.window_start, r.pu_borough): r.n for r in spark.read.parquet(out).collect()}
    last = messages.agg(F.max("pu_dt")).first()[0] - timedelta(hours=1)
    rows = rolling.usable(messages).select("pu_dt", "pu_borough").collect()
    want = {}
    for r in rows:
        hour = r.pu_dt.replace(minute=0, second=0, microsecond=0)
        for start_at in (hour, hour - timedelta(hours=1)):
            if start_at + timedelta(hours=2) <= last:
                want[(start_at, r.pu_borough)] = want.get((start_at, r.pu_borough), 0) + 1
    assert got == want

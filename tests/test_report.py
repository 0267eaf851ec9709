import glob

from pyspark.sql import functions as F

from curbside.session import scratch_path, shared_dir
from curbside.streaming.events import decode_all, decode_events
from curbside.streaming.report import ReportTable, report_job, rolling_rows
from curbside.streaming.replay import replay
from curbside.streaming.rolling import REPORT_TRIGGER, RollingReport

GOOD = '{"dataset":"yellow","pu_dt":"2024-01-01T00:%02d:00","pu_borough":"%s","pu_locid":%d,"fare_usd":%d}'


def messages(spark, first):
    rows = [(GOOD % (first + i, "ABCD"[i % 2], 1 + i % 3, i),) for i in range(6)] + [("{broken",), (None,)]
    return spark.createDataFrame(rows, "value string").coalesce(1)


def test_reports_of_a_timed_job(spark):
    state, table = RollingReport(scratch_path(spark, "rolling"), 900), ReportTable(scratch_path(spark, "reports"))

    def start(stream, progress):
        return report_job(stream, progress, state.update, lambda s, n: rolling_rows(state, s, n), table, "1 second")

    replay(spark, [messages(spark, 0), messages(spark, 30)], start, timed=True)
    rows = table.read(spark).collect()
    assert sorted({r.batch for r in rows}) == [0, 1]
    assert {(r.good, r.bad) for r in rows} == {(6, 2)}
    zones = {(r.batch, r.key): (r["rank"], r["values"]["seen"], r["values"]["n"]) for r in rows if r.scope == "zone"}
    assert zones[0, "1"] == (1, 2.0, 2.0) and zones[1, "3"] == (3, 4.0, 2.0)
    boroughs = {(r.batch, r.key): r["values"]["fare_usd_mean"] for r in rows if r.scope == "borough"}
    assert boroughs == {(0, "A"): 2.0, (0, "B"): 3.0, (1, "A"): 2.0, (1, "B"): 3.0}
    assert all(r.reported_at is not None for r in rows)


def test_messages_are_parsed_once(spark):
    """The state may read a batch's events several times; they come from storage, which is cleared after the batch."""
    seen = []

    def update(events, number):
        plan = events._jdf.queryExecution().toString()
        seen.append(("from_json" in plan, events.count(), events.filter("pu_borough = 'A'").count(), sorted(events.columns)))

    none = spark.createDataFrame([], "scope string, key string, rank int, values map<string,double>")
    replay(spark, [messages(spark, 0)], lambda s, p: report_job(
        s, p, update, lambda spark, n: none, ReportTable(scratch_path(spark, "reports")), "1 second"), timed=True)
    assert seen == [(False, 6, 3, sorted(decode_events(messages(spark, 0)).columns))]
    assert not glob.glob(f"{shared_dir(spark)}/curbside/decoded-*")


def test_decoded_with_the_bad_ones(spark):
    odd = ['{"fare_usd":"NaN","pu_locid":"132.0","pu_dt":"no time"}', "[]", "3", '"x"', "{}", "", " "]
    rows = messages(spark, 0).union(spark.createDataFrame([(v,) for v in odd], "value string"))
    every = decode_all(rows)
    good = sorted(map(str, decode_events(rows, observe=None).collect()))
    assert sorted(map(str, every.filter("good").drop("good").collect())) == good
    assert every.count() == 15 and every.filter("good IS NULL").count() == 0
    assert decode_all(messages(spark, 0))._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_repeated_batch_replaces_its_report(spark):
    table = ReportTable(scratch_path(spark, "reports"))
    rows = spark.range(3).select(F.lit("zone").alias("scope"), F.col("id").alias("key"), F.lit(1).alias("rank"),
                                 F.create_map(F.lit("n"), F.col("id").cast("double")).alias("values"))
    table.append(rows, 4, 3, 0)
    table.append(rows, 4, 5, 1)
    table.append(rows.limit(0), 5, 0, 0)
    assert {(r.batch, r.key, r.good, r.bad) for r in table.read(spark).collect()} == {(4, str(i), 5, 1) for i in range(3)}


def test_default_trigger():
    assert REPORT_TRIGGER == "10 seconds"

import pytest
from pyspark.sql import functions as F

from curbside.session import scratch_path
from curbside.streaming.bounded import BoundedIntake
from curbside.streaming.replay import replay

SCHEMA = "event_ms long, value string"


def messages(spark, first, n):
    return spark.range(first, first + n).select(F.col("id").alias("event_ms"), F.col("id").cast("string").alias("value"))


@pytest.mark.parametrize("sizes", [[100], [10, 90], [7] * 10, [40, 1, 59]])
def test_exactly_the_first_messages_at_any_batch_size(spark, sizes):
    intake, at = BoundedIntake(scratch_path(spark, "bounded"), 42), 0
    for number, size in enumerate(sizes):
        intake.update(messages(spark, at, size).repartition(5), number)
        at += size
    got = sorted(r.event_ms for r in intake.messages(spark, SCHEMA).collect())
    assert got == list(range(min(42, at))) and intake.reached(spark)


def test_a_repeated_batch_and_a_restart_count_once(spark):
    path = scratch_path(spark, "bounded")
    for _ in range(2):
        intake = BoundedIntake(path, 25)
        intake.update(messages(spark, 0, 20), 0)
        BoundedIntake(path, 25).update(messages(spark, 20, 20), 1)
        assert intake.admitted(spark) == 25 and intake.messages(spark, SCHEMA).count() == 25


def test_a_stream_ends_below_the_bound_or_at_it(spark):
    parts = [messages(spark, 0, 30), messages(spark, 30, 30)]
    for total, want in ((45, 45), (1000, 60)):
        intake = BoundedIntake(scratch_path(spark, "bounded"), total)
        replay(spark, parts, intake.writer)
        assert intake.messages(spark, SCHEMA).count() == want
    assert not intake.reached(spark)


def test_a_live_query_is_stopped_at_the_bound(spark):
    intake = BoundedIntake(scratch_path(spark, "bounded"), 5)
    stream = spark.readStream.format("rate").option("rowsPerSecond", 50).load().select(
        F.col("value").alias("event_ms"), F.col("value").cast("string").alias("value"))
    intake.run(intake.writer(stream, scratch_path(spark, "progress")).trigger(processingTime="1 second"), spark)
    assert intake.admitted(spark) == 5

from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from curbside.functions import columns as c


def one(spark, column, sql="SELECT 1 AS x"):
    return spark.sql(sql).select(column.alias("v")).first()["v"]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_mask_keeps_value_where_condition_is_null(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "v int, bad boolean")
    got = [r.o for r in df.select("v", c.mask(F.col("v"), F.col("bad")).alias("o")).orderBy("v").collect()]
    assert got == [None, 2, 3]


@pytest.mark.parametrize("unit, want", [
    ("hour", datetime(2024, 3, 13, 17)), ("day", datetime(2024, 3, 13)), ("week", datetime(2024, 3, 11)),
    ("month", datetime(2024, 3, 1)), ("year", datetime(2024, 1, 1)),
])
def test_period_start(spark, unit, want):
    assert one(spark, c.period_start(ts("2024-03-13 17:45:59.5"), unit)) == want


def test_tuesday_weeks_split_between_monday_and_tuesday(spark):
    assert one(spark, c.week_start(ts("2024-03-11 10:00:00"), 1)) == datetime(2024, 3, 5)
    assert one(spark, c.week_start(ts("2024-03-12 00:00:00"), 1)) == datetime(2024, 3, 12)


def test_elapsed_time_is_exact_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = one(spark, c.seconds_between(ts("2024-03-10 01:30:00"), ts("2024-03-10 03:30:00.25")))
        assert gap == 7200.25
        assert one(spark, c.epoch_millis(ts("1970-01-02 00:00:00.0019"))) == 86_400_001
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iso_text_round_trip(spark):
    assert one(spark, c.iso_format(ts("2024-01-01 02:03:04"))) == "2024-01-01T02:03:04"
    assert one(spark, c.iso_format(ts("2024-01-01 02:03:04.05"))) == "2024-01-01T02:03:04.050000"
    assert one(spark, c.iso_parse(F.lit("2024-01-01T02:03:04.05"))) == datetime(2024, 1, 1, 2, 3, 4, 50_000)
    assert one(spark, c.iso_parse(F.lit("soon"))) is None


def test_safe_cast_accepts_lossless_values(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-3.0,)], "v double")
    out = df.select(c.safe_cast(F.col("v"), T.DoubleType(), T.IntegerType()).alias("o"))
    assert [r.o for r in out.collect()] == [1, None, -3]


@pytest.mark.parametrize("value, source, target", [
    (1.5, "double", "int"), (float("nan"), "double", "int"), (300, "bigint", "tinyint"),
    (2**24 + 1, "bigint", "float"), ("x1", "string", "int"), (1e12, "double", "int"),
])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_safe_cast_refuses_lossy_values(spark, value, source, target, ansi):
    schema = T.StructType.fromDDL(f"v {source}, w {target}")
    df = spark.createDataFrame([(value,)], f"v {source}")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="does not fit"):
            df.select(c.safe_cast(F.col("v"), schema["v"].dataType, schema["w"].dataType).alias("o")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_yes_no(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("F",), ("?",), (None,)], "f string")
    assert [r.o for r in df.select(c.yes_no(F.col("f")).alias("o")).collect()] == [True, False, False, None, None]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (60.0,), (60.5,), (300.0,), (1e9,), (None,)], "v double")
    out = df.select(c.right_closed_bin(F.col("v"), [0, 60, 300, float("inf")]).alias("b"))
    assert [r.b for r in out.collect()] == [None, 0, 0, 1, 1, 2, None]

"""Trip, zone and event tables derived from the given TPC-H-like tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from curbside.operators.clean import EXTRAS, RENAMES, clean_trips
from curbside.operators.zones import with_boroughs
from curbside.session import prepare
from curbside.sources.feeds import PICKUP_COLUMN, feed_schema

READ_START = datetime(1995, 1, 1)
READ_END = datetime(2002, 1, 1)
SPLIT = datetime(1998, 7, 1)
LAST_SEEN = datetime(2001, 10, 1)
BOROUGHS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty trips of four feeds, one per lineitem row."""
    seconds = "((l_partkey * 3607 + l_suppkey * 61 + l_orderkey) % 86400)"
    fhv = "(l_returnflag = 'R' AND l_linestatus = 'F')"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_returnflag = 'A' THEN 'yellow' WHEN l_returnflag = 'N' THEN 'green' "
        "WHEN l_linestatus = 'F' THEN 'fhv' ELSE 'fhvhv' END AS dataset",
        "CAST(YEAR(l_shipdate) - CASE WHEN l_orderkey % 211 = 0 THEN 1 ELSE 0 END AS INT) AS src_year",
        f"CAST(l_shipdate + INTERVAL '1' SECOND * {seconds} AS TIMESTAMP_NTZ) AS pu_dt",
        f"CAST(l_shipdate + INTERVAL '1' SECOND * ({seconds} + CASE WHEN l_orderkey % 499 = 0 THEN 3456000 "
        "WHEN l_orderkey % 97 = 0 THEN 0 ELSE (l_orderkey * 7 + l_linenumber * 131) % 7500 - 300 END) "
        "AS TIMESTAMP_NTZ) AS do_dt",
        "CAST(l_partkey % 270 AS INT) AS pu_locid",
        "CAST((l_partkey * 31 + l_suppkey) % 270 AS INT) AS do_locid",
        "l_linenumber - 1 AS passengers",
        f"CASE WHEN {fhv} THEN NULL ELSE (l_quantity - 1) * 0.5 END AS distance",
        f"CASE WHEN {fhv} THEN NULL ELSE l_extendedprice / 100 - 20 END AS fee_fare",
        f"CASE WHEN {fhv} THEN NULL ELSE l_extendedprice * l_discount / 100 END AS fee_tip",
        "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice * (1 + l_discount + l_tax) / 100 - 20 END AS fee_total",
        "CASE WHEN l_returnflag = 'R' OR l_orderkey % 11 = 0 THEN NULL ELSE CAST(l_orderkey % 7 AS INT) END AS payment_type",
        "CASE WHEN l_returnflag <> 'R' OR l_suppkey % 23 = 0 THEN NULL WHEN l_suppkey % 19 = 0 THEN 'null' "
        "ELSE CONCAT('b', CAST(l_suppkey % 62 AS STRING)) END AS dbasenum",
        "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN CONCAT('HV000', CAST(2 + l_suppkey % 4 AS STRING)) END AS licensenum",
    )


def in_read_range(df: DataFrame) -> DataFrame:
    start, end = (F.lit(t).cast("timestamp_ntz") for t in (READ_START, READ_END))
    return df.filter((F.col("pu_dt") >= start) & (F.col("pu_dt") < end))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned trips within the read range."""
    return clean_trips(in_read_range(trips_raw(spark, sf_dir))).drop("src_year")


def feed(df: DataFrame, *names: str) -> DataFrame:
    return df.filter(F.col("dataset").isin(*names))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """263 zones with the region names as boroughs."""
    ids = prepare(spark).range(1, 264).withColumn("n_nationkey", (F.col("id") % 25).cast("int"))
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        ids.join(nation, "n_nationkey")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("id").cast("int").alias("locid"),
            F.concat(F.lit("Zone "), F.col("id").cast("string")).alias("zone"),
            F.col("r_name").alias("borough"),
        )
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips behind the event stream, one per events row, with ids but without boroughs."""
    later = "INTERVAL '1' SECOND * ((event_id * 7) % 5400)"
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 3 = 0 THEN 'yellow' ELSE 'fhvhv' END AS dataset",
        "ts AS pu_dt",
        f"ts + {later} AS do_dt",
        "CAST(user_id % 263 + 1 AS INT) AS pu_locid",
        "CAST((user_id * 31 + event_id) % 263 + 1 AS INT) AS do_locid",
        "CASE WHEN event_id % 13 <> 0 THEN CAST(get_json_object(props, '$.k') AS DOUBLE) / 10 END AS distance_miles",
        "value AS fare_usd",
        "CASE WHEN event_type = 'purchase' THEN value * 0.2D ELSE 0.0D END AS tip_usd",
        "CAST((event_id * 7) % 5400 AS DOUBLE) / 60.0D AS duration_minutes",
    )


def trip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_boroughs(event_trips(spark, sf_dir), zones(spark, sf_dir))


def pickup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the pickup borough only."""
    return with_boroughs(event_trips(spark, sf_dir), zones(spark, sf_dir), ("pu",))


# A trip column of the right kind fills every raw column the trip model does not have.
EXTRA_SOURCE = {
    T.FloatType(): "distance",
    T.IntegerType(): "passengers",
    T.StringType(): "CASE WHEN passengers % 2 = 0 THEN 'Y' ELSE 'N' END",
    T.TimestampNTZType(): "pu_dt",
    T.BooleanType(): "passengers > 2",
}


def raw_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One feed under its raw column names and target types, with the file year."""
    types = {f.name: f.dataType for f in feed_schema(name).fields}
    rows = feed(trips_raw(spark, sf_dir), name)
    columns = [F.col(new).cast(types[old]).alias(old) for old, new in RENAMES[name].items()]
    columns += [F.expr(EXTRA_SOURCE[types[c]]).cast(types[c]).alias(c) for c in EXTRAS[name]]
    return rows.select(*columns, "src_year")


def monthly_units(spark: SparkSession, sf_dir: str, name: str, folder: str) -> None:
    """Write one feed as monthly files ``<feed>_tripdata_<yyyy-MM>.parquet`` below a folder."""
    rows = raw_feed(spark, sf_dir, name).withColumn(
        "unit", F.concat(F.lit(f"{name}_tripdata_"), F.date_format(PICKUP_COLUMN[name], "yyyy-MM"), F.lit(".parquet"))
    )
    rows.drop("src_year").hint("rebalance", "unit").write.partitionBy("unit").parquet(folder)


# Years by which the repacked feeds are moved, so that the start months fall into them.
MOVED_YEARS = 20


def drifting_units(spark: SparkSession, sf_dir: str, name: str, folder: str) -> None:
    """Monthly files of a feed, twenty years on; whole numbers are doubles in the older half and longs in the newer."""
    pickup, years = PICKUP_COLUMN[name], F.expr(f"INTERVAL {MOVED_YEARS} YEAR")
    rows = raw_feed(spark, sf_dir, name).drop("src_year").withColumn(pickup, F.col(pickup) + years)
    rows = rows.withColumn("unit", F.concat(F.lit(f"{name}_tripdata_"), F.date_format(pickup, "yyyy-MM"), F.lit(".parquet")))
    whole = [f.name for f in feed_schema(name).fields if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)) and f.name in rows.columns]
    half = F.lit(SPLIT).cast("timestamp_ntz") + years
    for older, kind in ((True, "double"), (False, "bigint")):
        part = rows.filter((F.col(pickup) < half) == older).withColumns({c: F.col(c).cast(kind) for c in whole})
        part.hint("rebalance", "unit").write.mode("append").partitionBy("unit").parquet(folder)


# Columns of the drifting history, per year of pickup.
HISTORY = {
    1995: ["l_suppkey AS VendorID", "CAST(l_linenumber AS BIGINT) AS passenger_count", "l_tax AS mta_tax"],
    1996: ["l_suppkey AS VendorID", "CAST(l_linenumber AS DOUBLE) AS passenger_count", "l_tax AS mta_tax"],
    1997: ["l_suppkey AS VendorID", "CAST(l_linenumber AS DOUBLE) AS passenger_count", "l_tax AS mta_tax",
           "CASE WHEN l_orderkey % 3 <> 0 THEN l_discount END AS congestion_surcharge"],
    1998: ["l_suppkey AS VendorID", "CAST(l_linenumber AS DOUBLE) AS passenger_count",
           "l_discount AS congestion_surcharge"],
    1999: ["l_suppkey AS VendorID", "CAST(l_linenumber AS DOUBLE) AS passenger_count",
           "l_discount AS congestion_surcharge",
           "CASE WHEN l_orderkey % 5 <> 0 THEN l_tax END AS airport_fee"],
    2000: ["CAST(l_suppkey AS INT) AS VendorID", "CAST(l_linenumber AS BIGINT) AS passenger_count",
           "l_discount AS congestion_surcharge", "l_tax AS airport_fee"],
    2001: ["CAST(l_suppkey AS INT) AS VendorID", "CAST(l_linenumber AS BIGINT) AS passenger_count",
           "l_discount AS congestion_surcharge", "l_tax AS Airport_fee", "l_tax AS mta_tax"],
}
HISTORY_COMMON = [
    "l_shipdate AS tpep_pickup_datetime", "CAST(l_partkey % 270 AS BIGINT) AS PULocationID",
    "l_quantity AS trip_distance", "l_extendedprice AS fare_amount",
]


def schema_history(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write monthly files whose schema changes from year to year; a row of another year is an error."""
    known = F.year("l_shipdate").isin(*HISTORY)
    other = F.concat(F.lit("no columns are given for the year of "), F.coalesce(F.col("l_shipdate").cast("string"), F.lit("a null date")))
    lines = table(spark, sf_dir, "lineitem")
    lines.filter(~F.coalesce(known, F.lit(False))).select(F.raise_error(other)).write.format("noop").mode("overwrite").save()
    unit = "CONCAT('yellow_tripdata_', date_format(l_shipdate, 'yyyy-MM'), '.parquet') AS unit"
    for year, columns in HISTORY.items():
        start, end = (F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz") for y in (year, year + 1))
        rows = lines.filter((F.col("l_shipdate") >= start) & (F.col("l_shipdate") < end))
        part = rows.selectExpr(*HISTORY_COMMON, *columns, unit).hint("rebalance", "unit")
        part.write.mode("append").partitionBy("unit").parquet(folder)

"""The four trip feeds: raw column names, target schemas, monthly files, repacked tables."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

FEEDS = ("yellow", "green", "fhv", "fhvhv")

# Target schema of each repacked feed; ``year`` is the partition column.
FEED_SCHEMAS = {
    "yellow": (
        "airport_fee float, dolocationid int, pulocationid int, ratecodeid int, vendorid int, "
        "congestion_surcharge float, extra float, fare_amount float, improvement_surcharge float, "
        "mta_tax float, passenger_count int, payment_type tinyint, store_and_fwd_flag string, "
        "tip_amount float, tolls_amount float, total_amount float, "
        "tpep_dropoff_datetime timestamp_ntz, tpep_pickup_datetime timestamp_ntz, "
        "trip_distance float, year int"
    ),
    "green": (
        "dolocationid int, pulocationid int, ratecodeid int, vendorid int, "
        "congestion_surcharge float, ehail_fee float, extra float, fare_amount float, "
        "improvement_surcharge float, lpep_dropoff_datetime timestamp_ntz, "
        "lpep_pickup_datetime timestamp_ntz, mta_tax float, passenger_count int, "
        "payment_type int, store_and_fwd_flag string, tip_amount float, tolls_amount float, "
        "total_amount float, trip_distance float, trip_type int, year int"
    ),
    "fhv": (
        "affiliated_base_number string, dolocationid int, pulocationid int, sr_flag boolean, "
        "dispatching_base_num string, dropoff_datetime timestamp_ntz, "
        "pickup_datetime timestamp_ntz, year int"
    ),
    "fhvhv": (
        "dolocationid int, pulocationid int, access_a_ride_flag string, airport_fee float, "
        "base_passenger_fare float, bcf float, congestion_surcharge float, "
        "dispatching_base_num string, driver_pay float, dropoff_datetime timestamp_ntz, "
        "hvfhs_license_num string, on_scene_datetime timestamp_ntz, originating_base_num string, "
        "pickup_datetime timestamp_ntz, request_datetime timestamp_ntz, sales_tax float, "
        "shared_match_flag string, shared_request_flag string, tips float, tolls float, "
        "trip_miles float, trip_time int, wav_match_flag string, wav_request_flag string, year int"
    ),
}

# Pickup column of each feed.
PICKUP_COLUMN = {
    "yellow": "tpep_pickup_datetime",
    "green": "lpep_pickup_datetime",
    "fhv": "pickup_datetime",
    "fhvhv": "pickup_datetime",
}

# First month each feed is read from, and the common end of the read range.
FEED_START = {"yellow": (2012, 1), "green": (2014, 1), "fhv": (2015, 1), "fhvhv": (2019, 2)}
FEED_END = datetime(2025, 2, 1)

# Repack settings.
ROWS_PER_FILE = {"yellow": 2_000_000, "green": 2_000_000, "fhv": 2_000_000, "fhvhv": 1_000_000}

_MONTH_FILE = re.compile(r"\w+_(\d{4})-(\d{2})\.parquet")
# The same name inside a path; the month may be one file or a folder of part files.
_MONTH_UNIT = r"(?:^|[/=])(\w+)_(\d{4})-(\d{2})\.parquet(?:/|$)"


def feed_schema(feed: str) -> T.StructType:
    return T.StructType.fromDDL(FEED_SCHEMAS[feed])


def feed_kind(columns: Iterable[str]) -> str:
    """Which feed a set of column names belongs to, by its marker column."""
    names = {c.lower() for c in columns}
    if "tpep_pickup_datetime" in names:
        return "yellow"
    if "lpep_pickup_datetime" in names:
        return "green"
    if "hvfhs_license_num" in names:
        return "fhvhv"
    return "fhv"


def month_of_name(name: str) -> tuple[int, int]:
    """Year and month of a monthly file name; any other name is an error."""
    found = _MONTH_FILE.fullmatch(name.rsplit("/", 1)[-1])
    if found is None:
        raise ValueError(f"no year and month in file name {name!r}")
    return int(found[1]), int(found[2])


def month_columns(path: Column) -> tuple[Column, Column, Column]:
    """Category, year and month columns of a file path; a path without them fails the job."""
    category = F.regexp_extract(path, _MONTH_UNIT, 1)
    checked = F.when(category != "", category).otherwise(
        F.raise_error(F.concat(F.lit("no year and month in path "), path)).cast("string")
    )
    year = F.regexp_extract(path, _MONTH_UNIT, 2).try_cast("int")
    month = F.regexp_extract(path, _MONTH_UNIT, 3).try_cast("int")
    return checked, year, month


def from_start(year: Column, month: Column, start: tuple[int, int]) -> Column:
    """Whether a month is not before the start month."""
    return year * 100 + month >= start[0] * 100 + start[1]


def month_files(
    spark: SparkSession, folder: str, category: str, start: tuple[int, int]
) -> DataFrame:
    """One row per file of a category from the start month on, without opening any of them."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(f"{folder}/*{category}_????-??.parquet")
        .select("path", F.col("length").alias("bytes"))
    )
    found, year, month = month_columns(F.col("path"))
    return (
        listing.withColumns({"category": found, "src_year": year, "src_month": month})
        .filter((F.col("category") == category) & from_start(year, month, start))
        .select("category", "src_year", "src_month", "path", "bytes")
    )


def read_months(
    spark: SparkSession, folder: str, category: str, start: tuple[int, int]
) -> DataFrame:
    """Rows of a category's monthly files with ``src_year`` and ``src_month`` from the name.

    The conditions are on the file path alone, so Spark drops other files before reading. All
    months must have one schema; ``read_conformed`` takes months whose types drift.
    """
    rows = spark.read.option("recursiveFileLookup", "true").parquet(
        f"{folder}/*{category}_????-??.parquet"
    )
    found, year, month = month_columns(F.col("_metadata.file_path"))
    return rows.filter((found == category) & from_start(year, month, start)).select(
        "*", year.alias("src_year"), month.alias("src_month")
    )


def read_feed(
    spark: SparkSession,
    path: str,
    pickup: str,
    start: datetime,
    end: datetime = FEED_END,
) -> DataFrame:
    """Rows of a repacked feed picked up in ``[start, end)``.

    The year condition prunes partitions; the timestamp condition reaches the Parquet scan.
    """
    last_year = end.year if (end.month, end.day, end.time()) != (1, 1, datetime.min.time()) else end.year - 1
    rows = spark.read.parquet(path)
    ts = F.col(pickup)
    wanted = (ts >= F.lit(start).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz"))
    if "year" in rows.columns:
        wanted = F.col("year").between(start.year, last_year) & wanted
    return rows.filter(wanted)


def read_feed_default(spark: SparkSession, path: str, feed: str) -> DataFrame:
    year, month = FEED_START[feed]
    return read_feed(spark, path, PICKUP_COLUMN[feed], datetime(year, month, 1))


def read_partition(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """One partition of a partitioned table, without its partition column."""
    return spark.read.parquet(path).filter(F.col(column) == value).drop(column)


def normalise_location_names(df: DataFrame) -> DataFrame:
    """Rename any spelling of the two zone columns to pulocationid and dolocationid."""
    renames = {}
    for column in df.columns:
        plain = re.sub(r"[^a-z0-9]", "", column.lower())
        if plain in ("pulocationid", "dolocationid") and column != plain:
            renames[column] = plain
    return df.withColumnsRenamed(renames)


def feed_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """SQL view over every Parquet file below a folder."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(path)
    rows.createOrReplaceTempView(name)
    return rows


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone attributes (OBJECTID, zone, borough) from CSV or Parquet as locid, zone, borough."""
    if path.endswith(".csv") or path.endswith(".csv.gz"):
        table = spark.read.csv(path, header=True, schema="OBJECTID int, zone string, borough string")
    else:
        table = spark.read.parquet(path)
    return table.select(F.col("OBJECTID").cast("int").alias("locid"), "zone", "borough")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV or gzipped CSV with a header and a declared schema."""
    return spark.read.csv(path, schema=schema, header=True)

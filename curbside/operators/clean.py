"""From raw feeds to one cleaned trip table."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from curbside.functions.columns import mask, safe_cast, seconds_between, yes_no
from curbside.sources.feeds import feed_kind

# Raw column -> trip column, per feed.
RENAMES = {
    "yellow": {
        "tpep_pickup_datetime": "pu_dt",
        "tpep_dropoff_datetime": "do_dt",
        "pulocationid": "pu_locid",
        "dolocationid": "do_locid",
        "passenger_count": "passengers",
        "trip_distance": "distance",
        "fare_amount": "fee_fare",
        "tip_amount": "fee_tip",
        "total_amount": "fee_total",
        "payment_type": "payment_type",
    },
    "green": {
        "lpep_pickup_datetime": "pu_dt",
        "lpep_dropoff_datetime": "do_dt",
        "pulocationid": "pu_locid",
        "dolocationid": "do_locid",
        "passenger_count": "passengers",
        "trip_distance": "distance",
        "fare_amount": "fee_fare",
        "tip_amount": "fee_tip",
        "total_amount": "fee_total",
        "payment_type": "payment_type",
    },
    "fhv": {
        "pickup_datetime": "pu_dt",
        "dropoff_datetime": "do_dt",
        "pulocationid": "pu_locid",
        "dolocationid": "do_locid",
        "dispatching_base_num": "dbasenum",
    },
    "fhvhv": {
        "pickup_datetime": "pu_dt",
        "dropoff_datetime": "do_dt",
        "pulocationid": "pu_locid",
        "dolocationid": "do_locid",
        "trip_miles": "distance",
        "base_passenger_fare": "fee_fare",
        "tips": "fee_tip",
        "dispatching_base_num": "dbasenum",
        "hvfhs_license_num": "licensenum",
    },
}

# Raw columns kept under an ``x_`` name, per feed.
EXTRAS = {
    "yellow": (
        "airport_fee", "ratecodeid", "vendorid", "congestion_surcharge", "extra",
        "improvement_surcharge", "mta_tax", "store_and_fwd_flag", "tolls_amount",
    ),
    "green": (
        "ratecodeid", "vendorid", "congestion_surcharge", "ehail_fee", "extra",
        "improvement_surcharge", "mta_tax", "store_and_fwd_flag", "tolls_amount", "trip_type",
    ),
    "fhv": ("affiliated_base_number", "sr_flag"),
    "fhvhv": (
        "access_a_ride_flag", "airport_fee", "bcf", "congestion_surcharge", "driver_pay",
        "on_scene_datetime", "originating_base_num", "request_datetime", "sales_tax",
        "shared_match_flag", "shared_request_flag", "tolls", "trip_time", "wav_match_flag",
        "wav_request_flag",
    ),
}

# Zone range, longest believable trip.
FIRST_ZONE = 1
LAST_ZONE = 263
MAX_TRIP_DAYS = 30


def conform(df: DataFrame, schema: T.StructType, pickup: str, year: str = "year") -> DataFrame:
    """Case-insensitive pick of the schema's columns with safe casts.

    The ``year`` column, where the schema asks for one, is taken from the pickup time. A target
    column that the input lacks is an error. Files that disagree on types are read and
    conformed one generation at a time and stacked afterwards.
    """
    fields = {f.name.lower(): f for f in df.schema.fields}
    picked = []
    for target in schema.fields:
        if target.name == year:
            found, source, value = pickup, T.IntegerType(), F.year(F.col(fields[pickup].name))
        else:
            if target.name.lower() not in fields:
                raise ValueError(f"column {target.name!r} is missing from {df.columns}")
            field = fields[target.name.lower()]
            found, source, value = field.name, field.dataType, F.col(f"`{field.name}`")
        picked.append(safe_cast(value, source, target.dataType, found).alias(target.name))
    return df.select(*picked)


def clean_zones(df: DataFrame, columns: Iterable[str] = ("pu_locid", "do_locid"),
                first: int = FIRST_ZONE, last: int = LAST_ZONE) -> DataFrame:
    """Zone ids outside the known range become null."""
    return df.withColumns({c: mask(F.col(c), ~F.col(c).between(first, last)) for c in columns})


def clean_dropoff(df: DataFrame, pickup: str = "pu_dt", dropoff: str = "do_dt",
                  max_days: int = MAX_TRIP_DAYS) -> DataFrame:
    """Dropoff becomes null if not after the pickup or more than ``max_days`` later."""
    start, end = F.col(pickup), F.col(dropoff)
    latest = start + F.make_dt_interval(F.lit(max_days))
    return df.withColumn(dropoff, mask(end, (end <= start) | (latest < end)))


def clean_amounts(df: DataFrame,
                  positive: Iterable[str] = ("passengers", "distance"),
                  not_negative: Iterable[str] = ("fee_fare", "fee_tip", "fee_total")) -> DataFrame:
    """Zero or negative counts and negative fees become null, for the columns present."""
    changed = {c: mask(F.col(c), F.col(c) <= 0) for c in positive if c in df.columns}
    changed |= {c: mask(F.col(c), F.col(c) < 0) for c in not_negative if c in df.columns}
    return df.withColumns(changed) if changed else df


def clean_base(df: DataFrame, column: str = "dbasenum") -> DataFrame:
    """Upper-case base numbers; the text NULL becomes null."""
    if column not in df.columns:
        return df
    return df.withColumn(column, F.nullif(F.upper(F.col(column)), F.lit("NULL")))


def clean_trips(df: DataFrame) -> DataFrame:
    return df.transform(clean_zones).transform(clean_dropoff).transform(clean_amounts).transform(clean_base)


def universal_trips(raw: DataFrame, feed: str | None = None) -> DataFrame:
    """Rename one feed's columns to the common trip model and clean them."""
    feed = feed or feed_kind(raw.columns)
    picked = [F.col(old).alias(new) for old, new in RENAMES[feed].items()]
    picked += [F.col(name).alias(f"x_{name}") for name in EXTRAS[feed]]
    return clean_trips(raw.select(*picked))


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns one side lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_label(df: DataFrame, label: str | Column, column: str = "label") -> DataFrame:
    return df.withColumn(column, F.lit(label) if isinstance(label, str) else label)


def with_trip_time(df: DataFrame, pickup: str = "pu_dt", dropoff: str = "do_dt") -> DataFrame:
    """Trip duration in seconds."""
    return df.withColumn("trip_time", seconds_between(F.col(pickup), F.col(dropoff)))


def pick(df: DataFrame, *, keep: Iterable[str] | None = None, drop: Iterable[str] = ()) -> DataFrame:
    """Column subset, or everything but some columns."""
    unwanted = set(drop)
    return df.select(*[c for c in (keep if keep is not None else df.columns) if c not in unwanted])


def with_yes_no(df: DataFrame, column: str = "store_and_fwd_flag") -> DataFrame:
    """Text flag to boolean: Y true, N or F false, anything else null."""
    return df.withColumn(column, yes_no(F.col(column)))

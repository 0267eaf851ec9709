"""Anomaly audit of raw trips, by file year and by zone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from curbside.functions.columns import map_values
from curbside.operators.clean import FIRST_ZONE, LAST_ZONE

# Longest unsuspicious trip, highest unsuspicious fare.
LONG_TRIP_DAYS = 14
HIGH_FARE = 1000

# Readable names.
FLAG_NAMES = {
    "year_out_of_range": "Year out of range",
    "time_zero": "Pickup == dropoff",
    "time_negative": "Pickup > dropoff",
    "time_very_high": "Dropoff - pickup > 14 days",
    "location_invalid": "Invalid taxi zone",
    "distance_zero": "Trip distance == 0",
    "distance_negative": "Trip distance < 0",
    "fare_very_high": "Fare > 1000",
    "fare_negative": "Fare < 0",
}

# Raw columns each feed is audited on. Column lookup ignores case.
AUDIT_COLUMNS = {
    "yellow": dict(pickup="tpep_pickup_datetime", dropoff="tpep_dropoff_datetime",
                   pu_zone="PULocationID", do_zone="DOLocationID",
                   distance="trip_distance", fare="fare_amount"),
    "green": dict(pickup="lpep_pickup_datetime", dropoff="lpep_dropoff_datetime",
                  pu_zone="PULocationID", do_zone="DOLocationID",
                  distance="trip_distance", fare="fare_amount"),
    "fhv": dict(pickup="pickup_datetime", dropoff="dropOff_datetime",
                pu_zone="PUlocationID", do_zone="DOlocationID"),
    "fhvhv": dict(pickup="pickup_datetime", dropoff="dropoff_datetime",
                  pu_zone="PULocationID", do_zone="DOLocationID",
                  distance="trip_miles", fare="base_passenger_fare"),
}


def anomaly_flags(file_year: str, pickup: str, dropoff: str, pu_zone: str, do_zone: str,
                  distance: str | None = None, fare: str | None = None, *,
                  first_zone: int = FIRST_ZONE, last_zone: int = LAST_ZONE,
                  long_trip_days: int = LONG_TRIP_DAYS, high_fare: float = HIGH_FARE,
                  ) -> dict[str, Column]:
    """Named conditions; each may be null where an input is null."""
    start, end = F.col(pickup), F.col(dropoff)

    def zone_ok(name: str) -> Column:
        return F.col(name).isNull() | F.col(name).between(first_zone, last_zone)

    flags = {
        "year_out_of_range": F.year(start) != F.col(file_year),
        "time_zero": start == end,
        "time_negative": start > end,
        "time_very_high": (end - start) > F.make_dt_interval(F.lit(long_trip_days)),
        "location_invalid": ~(zone_ok(pu_zone) & zone_ok(do_zone)),
    }
    if distance:
        flags |= {"distance_zero": F.col(distance) == 0, "distance_negative": F.col(distance) < 0}
    if fare:
        flags |= {"fare_very_high": F.col(fare) > high_fare, "fare_negative": F.col(fare) < 0}
    return flags


def count_anomalies(df: DataFrame, flags: dict[str, Column], by: str = "src_year") -> DataFrame:
    """Rows and rows per flag, per file year: one scan, one small aggregate."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(cond).alias(name) for name, cond in flags.items()],
    )


def anomaly_fractions(counts: DataFrame, by: str = "src_year", leave_out: tuple[str, ...] = ()) -> DataFrame:
    """Share of rows per flag in long form, with readable flag names."""
    flags = [c for c in counts.columns if c not in (by, "rows", *leave_out)]
    shares = counts.select(by, *[(F.col(c) / F.col("rows")).alias(c) for c in flags])
    return shares.unpivot([by], flags, "flag", "fraction").select(
        F.col(by).alias("year"),
        map_values(F.col("flag"), FLAG_NAMES, keep_unmapped=True).alias("anomaly"),
        "fraction",
    )


def zone_ends(df: DataFrame, pu_zone: str, do_zone: str, *keep: str | Column,
              name: str = "locid") -> DataFrame:
    """Each trip once per end: pickup and dropoff zones stacked, without a second scan."""
    return df.select(*keep, F.explode(F.array(F.col(pu_zone), F.col(do_zone))).alias(name))


def any_flag(flags: dict[str, Column]) -> Column:
    """True if some flag is true; unknown flags count as not raised."""
    return F.coalesce(reduce(lambda a, b: a | b, flags.values()), F.lit(False))


def flagged_zone_ends(df: DataFrame, label: str | Column, flags: dict[str, Column],
                      pu_zone: str, do_zone: str) -> DataFrame:
    """(label, is_err, locid) rows for both ends of each trip.

    Pickup and dropoff zones come from their own columns for every feed.
    """
    marked = df.select(
        (F.lit(label) if isinstance(label, str) else label).alias("label"),
        any_flag(flags).alias("is_err"),
        F.col(pu_zone).alias("_pu"),
        F.col(do_zone).alias("_do"),
    )
    return zone_ends(marked, "_pu", "_do", "label", "is_err")


def anomalies_by_zone(ends: DataFrame, first_zone: int = FIRST_ZONE, last_zone: int = LAST_ZONE) -> DataFrame:
    """Rows and erroneous rows per (label, zone), known zones only."""
    return (
        ends.filter(F.col("locid").between(first_zone, last_zone))
        .groupBy("label", "locid")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("is_err")).alias("errors"))
    )


def zone_error_rate(by_zone: DataFrame) -> DataFrame:
    return by_zone.withColumn("error_rate", F.col("errors") / F.col("rows"))


def top_zones_by_rate(rates: DataFrame, k: int = 5) -> DataFrame:
    """The k zones with the highest rate per label; the lower zone id wins a tie."""
    order = Window.partitionBy("label").orderBy(F.col("error_rate").desc(), F.col("locid"))
    return rates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

"""Fares, tips, payment types and trip durations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curbside.functions.columns import map_values, right_closed_bin, seconds_between
from curbside.operators.quantiles import describe, quantile_brackets, rank_summary
from curbside.session import checkpointed, small_side

# Payment type names; rows without a type count as 5.
PAYMENT_NAMES = {
    0: "Flex fare",
    1: "Card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
UNKNOWN_PAYMENT = 5

# Right-closed duration bins in seconds and their names.
DURATION_EDGES = [0, 60, 300, 600, 1800, 3600, 10800, 21600, 43200, 64800, 86400, float("inf")]
DURATION_NAMES = [
    "0-60s", "1-5min", "5-10min", "10-30min", "30-60min", "1-3h", "3-6h", "6-12h", "12-18h",
    "18-24h", "24h+",
]


def fare_by_zone(trips: DataFrame) -> DataFrame:
    """Mean fare per pickup zone."""
    return (
        trips.filter(F.col("pu_locid").isNotNull())
        .groupBy("pu_locid")
        .agg(F.avg("fee_fare").alias("fare_mean"))
    )


def payment_types(trips: DataFrame, label: str = "label") -> DataFrame:
    """Rides per (label, payment type) with the type's name."""
    kind = F.coalesce(F.col("payment_type"), F.lit(UNKNOWN_PAYMENT))
    counts = trips.groupBy(label, kind.alias("payment_type")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        label, "payment_type", map_values(F.col("payment_type"), PAYMENT_NAMES).alias("payment_name"), "n"
    )


def trip_time_bins(trips: DataFrame, label: str = "label") -> DataFrame:
    """Rides per (label, duration bin); trips without a positive duration or a label drop out."""
    positive = trips.filter(F.col(label).isNotNull() & (F.col("do_dt") > F.col("pu_dt")))
    timed = positive.select(label, seconds_between(F.col("pu_dt"), F.col("do_dt")).alias("_seconds"))
    bin_order = right_closed_bin(F.col("_seconds"), DURATION_EDGES)
    counts = timed.groupBy(label, bin_order.alias("bin_order")).agg(F.count(F.lit(1)).alias("n"))
    names = map_values(F.col("bin_order"), dict(enumerate(DURATION_NAMES)))
    return counts.select(label, "bin_order", names.alias("time"), "n")


def distance_fare_curve(trips: DataFrame, bins_per_decade: int = 100) -> DataFrame:
    """Mean fare and rides per logarithmic distance bucket, with the bucket's start."""
    bucket = F.floor(F.log10("distance") * bins_per_decade).cast("int")
    return (
        trips.filter(F.col("distance") > 0)
        .groupBy(bucket.alias("bucket"))
        .agg(F.avg("fee_fare").alias("fare"), F.count(F.lit(1)).alias("n"))
        .withColumn("distance", F.pow(F.lit(10.0), F.col("bucket") / float(bins_per_decade)))
    )


def fare_buckets(trips: DataFrame, label: str = "label", width: int = 10, max_fare: float = 1000) -> DataFrame:
    """(label, fare bucket middle, tip) of trips with both amounts and a fare below the limit."""
    amounts = trips.select(label, "fee_fare", "fee_tip").dropna()
    middle = F.floor(F.col("fee_fare") / width) * width + width // 2
    return amounts.filter(F.col("fee_fare") < max_fare).select(
        label, middle.cast("int").alias("fare"), "fee_tip"
    )


def tip_limits(buckets: DataFrame, label: str = "label", quantile: float = 0.95) -> DataFrame:
    """Approximate tip quantile per (label, bucket) in one pass."""
    return buckets.groupBy(label, "fare").agg(
        F.percentile_approx("fee_tip", quantile, 10_000).alias("tip_max")
    )


def fare_tip_curve(trips: DataFrame, label: str = "label", quantile: float = 0.95,
                   accuracy: int = 1000) -> DataFrame:
    """Mean tip per (label, fare bucket) of the tips strictly below the bucket's quantile.

    The exact quantile and the mean both come from one compact rank summary: the trips are read
    twice, and only tips near the quantile leave the map side one by one. Rows without a label
    belong to no curve.
    """
    keys = [label, "fare"]
    buckets = fare_buckets(trips, label)
    brackets = quantile_brackets(buckets, keys, "fee_tip", [quantile], accuracy)
    summary = rank_summary(buckets, keys, "fee_tip", brackets, 1)
    limits = describe(summary, keys, [quantile]).select(*keys, F.col("quantiles")[0].alias("tip_max"))
    return (
        summary.join(small_side(checkpointed(limits)), keys)
        .filter(F.col("hi") < F.col("tip_max"))
        .groupBy(*keys)
        .agg((F.sum("total") / F.sum("n")).alias("tip"), F.sum("n").alias("n"))
    )


def displayed_points(curve: DataFrame, min_rides: int = 10, max_fare: int = 600) -> DataFrame:
    """Points with enough rides, below the display limit."""
    return curve.filter((F.col("n") > min_rides) & (F.col("fare") < max_fare))

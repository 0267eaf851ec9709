"""Event features and exponentially decayed weights."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from curbside.functions.columns import epoch_millis, finite

# Boroughs of the one-hot part, default half-life.
BOROUGHS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR")
HALF_LIFE_MINUTES = 360.0


def _log_scaled(value: Column, scale: float) -> Column:
    """log1p(x) / scale; zero if the value is missing, not finite or not positive."""
    x = finite(value)
    return F.when((x > 0) & (x < float("inf")), F.log1p(x)).otherwise(0.0) / scale


def feature_columns(ts: str = "pu_dt", borough: str = "pu_borough",
                    boroughs: Sequence[str] = BOROUGHS) -> list[Column]:
    """Hour and weekday on the circle, log amounts, borough one-hot."""
    t = F.col(ts)
    hour = 2.0 * math.pi * ((F.hour(t) + F.minute(t) / 60.0) / 24.0)
    weekday = 2.0 * math.pi * (F.weekday(t) / 7.0)
    amounts = [("distance_miles", 5.0), ("fare_usd", 6.0), ("tip_usd", 5.0), ("duration_minutes", 6.0)]
    return [
        F.sin(hour), F.cos(hour), F.sin(weekday), F.cos(weekday),
        *[_log_scaled(F.col(name), scale) for name, scale in amounts],
        *[F.when(F.col(borough) == name, 1.0).otherwise(0.0) for name in boroughs],
    ]


def with_features(events: DataFrame, ts: str = "pu_dt", borough: str = "pu_borough",
                  boroughs: Sequence[str] = BOROUGHS) -> DataFrame:
    """Add the feature vector as an array; events without a time are rejected."""
    return events.filter(F.col(ts).isNotNull()).withColumn(
        "features", F.array(*feature_columns(ts, borough, boroughs))
    )


def decay_factor(age_ms: Column, half_life_minutes: float = HALF_LIFE_MINUTES) -> Column:
    """0.5 to the age in half-lives; one for events that are not older."""
    return F.when(age_ms <= 0, 1.0).otherwise(F.pow(F.lit(0.5), age_ms / (half_life_minutes * 60_000.0)))


def decayed_weight(events: DataFrame, by: Sequence[str], now: DataFrame, ts: str = "pu_dt",
                   half_life_minutes: float = HALF_LIFE_MINUTES) -> DataFrame:
    """Sum of decayed unit weights per group, seen from the one-row table ``now``(now_ms).

    The table is a scalar subquery, so more than one row is an error.
    """
    aged = events.withColumn("now_ms", now.select("now_ms").scalar())
    age = F.col("now_ms") - epoch_millis(F.col(ts))
    return aged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(decay_factor(age, half_life_minutes)).alias("weight")
    )


def latest_ms(events: DataFrame, ts: str = "pu_dt") -> DataFrame:
    """One row: epoch milliseconds of the last event."""
    return events.agg(epoch_millis(F.max(ts)).alias("now_ms"))

"""Ride volume by period, hour and week profile, zone and origin-destination pair."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from curbside.functions.columns import map_values, week_start
from curbside.operators.anomaly import zone_ends

LABELS = ("yellow", "green", "fhv_small", "fhv_big")

# Readable label names, in display order.
LABEL_NAMES = {
    "yellow": "Yellow",
    "green": "Green",
    "fhv_small": "FHV (Other)",
    "fhv_big": "FHV (Uber/Lyft)",
}

# Fixed value: the period split.
SPLIT = datetime(2020, 4, 1)


def rides_by_period(trips: DataFrame, unit: str, label: str, ts: str = "pu_dt") -> DataFrame:
    """Rides per (period, label); rows without a time or a label are left out.

    Rows are grouped by date (and hour), and only the groups are turned into timestamps.
    """
    day = F.to_date(ts)
    parts = [day.alias("_day"), F.hour(ts).alias("_hour")] if unit == "hour" else [
        (day if unit == "day" else F.trunc(day, unit)).alias("_day"), F.lit(0).alias("_hour")
    ]
    counted = (
        trips.filter(F.col(ts).isNotNull() & F.col(label).isNotNull())
        .groupBy(*parts, label)
        .agg(F.count(F.lit(1)).alias("volume"))
    )
    start = F.col("_day").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("_hour"))
    return counted.select(start.alias(unit), label, "volume")


def day_profile(hourly: DataFrame, label: str = "label", side: list[str] = ()) -> DataFrame:
    """Average share of a day's rides by hour of day and label.

    Shares are of the day's rides over all labels; hours without rides count as zero. Input is
    the hourly volume, so the windows run over hours, not trips.
    """
    days = hourly.withColumns({"_period": F.to_date("hour"), "_slot": F.hour("hour")})
    return _average_share(days, label, list(side), "hour")


def week_profile(hourly: DataFrame, label: str = "label", side: list[str] = (),
                 first_weekday: int = 1) -> DataFrame:
    """Average share of a week's rides by weekday (0 = Monday) and label.

    Weeks run Tuesday to Monday by default.
    """
    daily = hourly.groupBy(*side, F.to_date("hour").alias("_day"), label).agg(F.sum("volume").alias("volume"))
    weeks = daily.withColumns({
        "_period": week_start(F.col("_day"), first_weekday),
        "_slot": F.weekday("_day"),
    })
    return _average_share(weeks, label, list(side), "weekday")


def _average_share(rows: DataFrame, label: str, side: list[str], slot: str) -> DataFrame:
    """Sum of the shares per (slot, label) over the number of distinct periods of the side.

    The first row of a period carries the period's count of one, so the periods are counted on
    the way and the volume is read once.
    """
    period = Window.partitionBy(*side, "_period")
    first = F.row_number().over(period.orderBy("_slot", label)) == 1
    shares = rows.withColumns({
        "_share": F.col("volume") / F.sum("volume").over(period),
        "_first": first.cast("int"),
    })
    summed = shares.groupBy(*side, F.col("_slot").alias(slot), label).agg(
        F.sum("_share").alias("_share"), F.sum("_first").alias("_firsts")
    )
    # One row per (side, slot, label).
    periods = F.sum("_firsts").over(Window.partitionBy(*side) if side else Window.partitionBy(F.lit(0)))
    return summed.select(*side, slot, label, (F.col("_share") / periods).alias("volume"))


def with_side(hourly: DataFrame, split: datetime = SPLIT) -> DataFrame:
    """Mark rows as before or from the split time on."""
    cut = F.lit(split).cast("timestamp_ntz")
    return hourly.withColumn("side", F.when(F.col("hour") < cut, "before").otherwise("after"))


def volume_by_zone(trips: DataFrame, label: str = "label") -> DataFrame:
    """Pickups plus dropoffs per (zone, label)."""
    return (
        zone_ends(trips, "pu_locid", "do_locid", label)
        .dropna(subset=["locid", label])
        .groupBy("locid", label)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def volume_by_arc(trips: DataFrame) -> DataFrame:
    """Rides per (pickup zone, dropoff zone), both known."""
    return (
        trips.dropna(subset=["pu_locid", "do_locid"])
        .groupBy("pu_locid", "do_locid")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_zones(arcs: DataFrame, k: int = 10) -> DataFrame:
    """The k zones with most rides at either end, ranked; a loop counts at both ends."""
    totals = zone_ends(arcs, "pu_locid", "do_locid", "n").groupBy("locid").agg(F.sum("n").alias("n"))
    best = totals.orderBy(F.col("n").desc(), "locid").limit(k)
    return best.withColumn(
        "rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc(), "locid"))
    )


def arc_matrix(arcs: DataFrame, top: DataFrame) -> DataFrame:
    """Arcs among the top zones with both ranks and log10 of the volume."""
    pu = top.select(F.col("locid").alias("pu_locid"), F.col("rank").alias("pu_rank"))
    do = top.select(F.col("locid").alias("do_locid"), F.col("rank").alias("do_rank"))
    return arcs.join(pu, "pu_locid").join(do, "do_locid").select(
        "pu_rank", "do_rank", "pu_locid", "do_locid", "n", F.log10("n").alias("log_n")
    )


def arc_matrix_wide(matrix: DataFrame, k: int = 10) -> DataFrame:
    """One row per pickup rank, one log10 column per dropoff rank."""
    wide = matrix.groupBy("pu_rank", "pu_locid").pivot("do_rank", list(range(1, k + 1))).agg(F.first("log_n"))
    return wide.withColumnsRenamed({str(i): f"to_{i}" for i in range(1, k + 1)})


def pivot_volume(volume: DataFrame, index: str, label: str, labels: tuple[str, ...]) -> DataFrame:
    """Long to wide with one column per known label; missing combinations are zero."""
    return volume.groupBy(index).pivot(label, list(labels)).sum("volume").fillna(0)


def volume_share(volume: DataFrame, index: str, label: str, labels: tuple[str, ...]) -> DataFrame:
    """Share of each label in the period's rides; a label without rides has share zero."""
    wide = pivot_volume(volume, index, label, labels)
    total = sum((F.col(name) for name in labels[1:]), F.col(labels[0]))
    shares = wide.select(index, *[(F.col(name) / total).alias(name) for name in labels])
    return shares.unpivot([index], list(labels), label, "share")


def with_label_name(df: DataFrame, label: str = "label") -> DataFrame:
    """Readable label and its place in the display order."""
    order = {name: i for i, name in enumerate(LABEL_NAMES)}
    return df.withColumns({
        "label_name": map_values(F.col(label), LABEL_NAMES),
        "label_order": map_values(F.col(label), order),
    })


def log_scale(df: DataFrame, value: str = "n") -> DataFrame:
    """Smallest and largest log10 of a count, for a common scale."""
    return df.agg(F.min(F.log10(value)).alias("log_min"), F.max(F.log10(value)).alias("log_max"))

"""Joins with the zone dimension and other small tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curbside.session import checkpointed, lookup, small_side


def join_zone_names(df: DataFrame, zones: DataFrame, key: str = "locid", prefix: str = "") -> DataFrame:
    """Left join of zone and borough names; unknown zones keep null names.

    The zone table is broadcast only if its row count allows it, so a fact table on the left
    is not shuffled for a few hundred names.
    """
    names = zones.select(
        F.col("locid").alias(key), F.col("zone").alias(f"{prefix}zone"), F.col("borough").alias(f"{prefix}borough")
    )
    return lookup(df, names, key)


def join_zone_names_twice(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Names for both ends of a trip or an origin-destination pair."""
    return df.transform(join_zone_names, zones, "pu_locid", "pu_").transform(
        join_zone_names, zones, "do_locid", "do_"
    )


def zones_right_join(df: DataFrame, zones: DataFrame, key: str = "locid") -> DataFrame:
    """Zone attributes joined from the right: every result row stays, zones without one go."""
    attributes = zones.withColumnRenamed("locid", "_zone_key")
    return attributes.join(df, F.col("_zone_key") == F.col(key), "right").drop("_zone_key")


def with_boroughs(df: DataFrame, zones: DataFrame, ends: tuple[str, ...] = ("pu", "do")) -> DataFrame:
    """Pickup and dropoff borough by id lookup, null where unknown. Works on streams too."""
    for end in ends:
        side = zones.select(F.col("locid").alias(f"{end}_locid"), F.col("borough").alias(f"{end}_borough"))
        df = lookup(df, side, f"{end}_locid")
    return df


def borough_sample(df: DataFrame, zones: DataFrame, rows: int = 5) -> DataFrame:
    """A few trips with the boroughs of both ends, to look at."""
    return with_boroughs(df.select("pu_locid", "do_locid").limit(rows), zones)


def boroughs_present(df: DataFrame, zones: DataFrame, label: str = "dataset") -> DataFrame:
    """Distinct boroughs at either end, per label and overall (label ``all``).

    Trips collapse to distinct (label, zone) pairs before the names are joined.
    """
    ends = df.select(label, F.explode(F.array("pu_locid", "do_locid")).alias("locid")).distinct()
    named = join_zone_names(ends, zones).filter(F.col("borough").isNotNull())
    return (
        named.select(F.explode(F.array(F.col(label), F.lit("all"))).alias(label), "borough").distinct()
    )


def resolve_ids(spark: SparkSession, ids: Iterable[int], zones: DataFrame) -> DataFrame:
    """Names of a literal id list, in list order."""
    rows = [(position, locid) for position, locid in enumerate(ids)]
    wanted = spark.createDataFrame(rows, "position int, locid int")
    return wanted.join(zones, "locid", "left").orderBy("position")


def keep_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows whose column is in an id table."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(column)), column, "left_semi")


def drop_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows whose column is not in an id table; null ids stay."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(column)), column, "left_anti")


def full_join_with_origin(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Full outer join with a left_only / right_only / both marker."""
    joined = left.withColumn("_l", F.lit(True)).join(right.withColumn("_r", F.lit(True)), on, "full")
    origin = (
        F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("both")
    )
    return joined.withColumn("origin", origin).drop("_l", "_r")


def below_threshold(df: DataFrame, limits: DataFrame, on: list[str], value: str, limit: str) -> DataFrame:
    """Rows strictly below their group's threshold.

    The thresholds are written once, so that checking their number does not compute them twice;
    the fact side is not shuffled for a small table.
    """
    return df.join(small_side(checkpointed(limits)), on, "left").filter(F.col(value) < F.col(limit))


def isin_or_false(column: Column, values: Iterable) -> Column:
    """Membership with null counted as not a member."""
    return F.coalesce(column.isin(*values), F.lit(False))

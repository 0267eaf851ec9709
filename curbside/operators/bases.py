"""Which dispatch bases belong to the big app operators, and the labels that follow."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from curbside.functions.columns import mask, period_start
from curbside.operators.zones import full_join_with_origin, isin_or_false
from curbside.session import checkpointed, lookup

# Licenses of the big operators, day their bases vanish from the fhv feed.
BIG_LICENSES = ("HV0003", "HV0005")
LAST_DAY = datetime(2019, 1, 31)


def license_counts(fhvhv: DataFrame, license: str = "licensenum") -> DataFrame:
    """Rows per license; rows without one are a group too."""
    return fhvhv.groupBy(license).agg(F.count(F.lit(1)).alias("n"))


def base_last_seen(fhv: DataFrame, unit: str = "day", when: datetime = LAST_DAY,
                   base: str = "dbasenum", ts: str = "pu_dt") -> DataFrame:
    """Bases whose last pickup falls into the given day (or month)."""
    last = (
        fhv.filter(F.col(base).isNotNull())
        .groupBy(F.upper(base).alias("dbn"))
        .agg(F.max(ts).alias("ls"))
    )
    return last.filter(period_start(F.col("ls"), unit) == F.lit(when).cast("timestamp_ntz"))


def base_license_pairs(fhvhv: DataFrame, base: str = "dbasenum", license: str = "licensenum") -> DataFrame:
    """Distinct (base, license) of the app feed; the text NULL, in any case, is no base."""
    return (
        fhvhv.select(F.upper(base).alias("dbn"), F.col(license).alias("ln"))
        .filter(F.col("dbn") != "NULL")
        .distinct()
    )


def base_multi_license(pairs: DataFrame) -> DataFrame:
    """Bases used under more than one license."""
    return pairs.groupBy("dbn").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def base_breakdown(last_seen: DataFrame, pairs: DataFrame) -> DataFrame:
    """Vanished bases against app bases, with where each was found."""
    return full_join_with_origin(last_seen, pairs, "dbn")


def base_sets(breakdown: DataFrame, big: tuple[str, ...] = BIG_LICENSES) -> DataFrame:
    """(operator, dbn): bases in both feeds, by operator size. A base can be in both sets."""
    size = F.when(isin_or_false(F.col("ln"), big), "big").otherwise("small")
    return breakdown.filter(F.col("origin") == "both").select(size.alias("operator"), "dbn").distinct()


def big_bases(fhv: DataFrame, fhvhv: DataFrame, big: tuple[str, ...] = BIG_LICENSES,
              unit: str = "day", when: datetime = LAST_DAY) -> DataFrame:
    """Bases of the big operators, written once so that labelling does not recompute them."""
    breakdown = base_breakdown(base_last_seen(fhv, unit, when), base_license_pairs(fhvhv))
    sets = base_sets(breakdown, big).filter(F.col("operator") == "big")
    return checkpointed(sets.select("dbn"))


def label_fhv(fhv: DataFrame, bases: DataFrame, base: str = "dbasenum") -> DataFrame:
    """fhv_big for bases of the big operators, else fhv_small; no base, no label."""
    flagged = bases.select(F.col("dbn").alias(base), F.lit(True).alias("_big"))
    label = F.when(F.col("_big"), "fhv_big").otherwise("fhv_small")
    return (
        lookup(fhv, flagged, base)
        .withColumn("label", mask(label, F.col(base).isNull()))
        .drop("_big")
    )


def label_fhvhv(fhvhv: DataFrame, big: tuple[str, ...] = BIG_LICENSES, license: str = "licensenum") -> DataFrame:
    """fhv_big for the big operators' licenses, else fhv_small; no license, no label."""
    label = F.when(F.col(license).isin(*big), "fhv_big").otherwise("fhv_small")
    return fhvhv.withColumn("label", mask(label, F.col(license).isNull()))


def label_stacked(trips: DataFrame, bases: DataFrame, big: tuple[str, ...] = BIG_LICENSES,
                  dataset: str = "dataset") -> DataFrame:
    """Labels of all feeds in one scan of the stacked table: taxis keep their feed's name."""
    flagged = bases.select(F.col("dbn").alias("dbasenum"), F.lit(True).alias("_big"))
    fhv = F.when(F.col("_big"), "fhv_big").otherwise("fhv_small")
    app = F.when(F.col("licensenum").isin(*big), "fhv_big").otherwise("fhv_small")
    label = (
        F.when(F.col(dataset) == "fhv", mask(fhv, F.col("dbasenum").isNull()))
        .when(F.col(dataset) == "fhvhv", mask(app, F.col("licensenum").isNull()))
        .otherwise(F.col(dataset))
    )
    return lookup(trips, flagged, "dbasenum").withColumn("label", label).drop("_big")

"""Per-column statistics of several feeds in long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from curbside.operators.quantiles import approx_quantile, bracket_cuts, describe, rank_summary
from curbside.session import checkpointed

# Profiled columns, and those each feed has.
COLUMNS = ("passengers", "distance", "trip_time", "fee_fare", "fee_tip", "fee_total")
PRESENT = {
    "yellow": ("passengers", "distance", "trip_time", "fee_fare", "fee_tip", "fee_total"),
    "green": ("passengers", "distance", "trip_time", "fee_fare", "fee_tip", "fee_total"),
    "fhv": ("trip_time",),
    "fhvhv": ("distance", "trip_time", "fee_fare", "fee_tip"),
}
QUARTILES = (0.25, 0.5, 0.75)


def melt(df: DataFrame, label: str, columns: Sequence[str] = COLUMNS,
         present: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(label, col, value) rows for the columns the table and the feed have; NaN is null."""
    found = [c for c in columns if c in df.columns]
    long = df.select(label, *[F.col(c).cast("double") for c in found]).unpivot([label], found, "col", "value")
    if present is not None:
        known = F.lit(False)
        for name, names in present.items():
            known = known | ((F.col(label) == name) & F.col("col").isin(*names))
        long = long.filter(known)
    return long.withColumn("value", F.nanvl("value", F.lit(None).cast("double")))


def _with_quartiles(stats: DataFrame, label: str) -> DataFrame:
    q = F.col("quantiles")
    return stats.select(
        label, "col", "mean", "std", "min", "max", "frac_null",
        q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), (q[2] - q[0]).alias("iqr"),
    )


def _column_brackets(df: DataFrame, label: str, columns: Sequence[str], accuracy: int) -> DataFrame:
    """Brackets of the quartiles per (label, column) of a wide table; NaN is null."""
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    cuts = df.groupBy(label).agg(*[F.percentile_approx(value(c), bracket_cuts(QUARTILES, accuracy), accuracy).alias(c) for c in columns])
    return checkpointed(cuts.unpivot([label], list(columns), "col", "_cuts"))


def colstats(df: DataFrame, label: str = "dataset", columns: Sequence[str] = COLUMNS,
             present: Mapping[str, Sequence[str]] | None = PRESENT, accuracy: int = 1000) -> DataFrame:
    """Mean, sample deviation, range, null share and exact quartiles per (feed, column).

    Two passes: a sketch brackets the quartiles, then one compact rank summary gives everything. The sketches of
    all columns come from one aggregate over rows as wide as they are; its few rows are melted afterwards.
    """
    keys = [label, "col"]
    long = melt(df, label, columns, present)
    brackets = _column_brackets(df, label, [c for c in columns if c in df.columns], accuracy)
    stats = describe(rank_summary(long, keys, "value", brackets, len(QUARTILES)), keys, QUARTILES)
    share = 1 - F.col("n") / (F.col("n") + F.col("nulls"))
    return _with_quartiles(stats.withColumn("frac_null", share), label)


def colstats_approx(df: DataFrame, label: str = "dataset", columns: Sequence[str] = COLUMNS,
                    present: Mapping[str, Sequence[str]] | None = PRESENT, accuracy: int = 10_000) -> DataFrame:
    """The same in one pass with sketch quartiles."""
    stats = melt(df, label, columns, present).groupBy(label, "col").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        (1 - F.count("value") / F.count(F.lit(1))).alias("frac_null"),
        approx_quantile(F.col("value"), QUARTILES, accuracy).alias("quantiles"),
    )
    return _with_quartiles(stats, label)


def as_intervals(stats: DataFrame, col: str = "trip_time", label: str = "dataset") -> DataFrame:
    """Statistics of a column in seconds as day-time intervals."""
    names = ["mean", "std", "min", "max", "q25", "q50", "q75", "iqr"]
    zero = F.lit(0)
    return stats.filter(F.col("col") == col).select(
        label, *[F.make_dt_interval(zero, zero, zero, F.col(n).cast("decimal(18,6)")).alias(n) for n in names]
    )

"""Quantiles: mergeable approximations, and exact values by bracketing.

The exact form never orders a group, or a fixed share of one, in one task. A first pass brackets
every wanted quantile with a bounded sketch; a second pass collapses everything outside the
brackets to a handful of rows per group on the map side, so only about ``4 / accuracy`` of the
rows (and of those, only distinct values) stay. Ranks are then found by counting per range of
values and narrowing the ranges that hold them, until a group has at most ``POINTS`` rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curbside.session import checkpointed, small_side

# Rows a group is ordered by at most, and cuts of a segment of one that has more.
POINTS, CELLS = 10_000, 64


def approx_quantile(value: Column, quantile: float | Iterable[float] = 0.5, accuracy: int = 10_000) -> Column:
    """Mergeable approximate quantile aggregate: one quantile gives a value, several an array."""
    wanted = list(quantile) if isinstance(quantile, Iterable) else [quantile]
    if not wanted:
        raise ValueError("at least one quantile is needed")
    return F.percentile_approx(value, wanted[0] if len(wanted) == 1 else wanted, accuracy)


def sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = 800) -> DataFrame:
    """One storable quantile sketch per group, as a binary column."""
    return df.groupBy(*keys).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"),
        F.count(value).alias("n"),
    )


def merge_sketches(stored: DataFrame, keys: Sequence[str], k: int = 800) -> DataFrame:
    """Sketches of coarser groups from stored ones, without the rows behind them."""
    return stored.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n")
    )


@dataclass
class SketchTable:
    """Sketches per key and unit of time below ``path``, a folder per unit; units that are there are not sketched again."""

    path: str
    keys: Sequence[str]
    unit: str
    value: str
    k: int = 800

    def units(self, spark: SparkSession) -> DataFrame | None:
        """The units sketched so far, from the names of their folders alone."""
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
            return None
        return spark.read.parquet(self.path).select(F.col("_unit").cast("string").alias("_unit")).distinct()

    def update(self, df: DataFrame) -> None:
        """Sketch the units of ``df`` that the table lacks; rows of the others are filtered before they are aggregated."""
        rows = df.filter(F.col(self.unit).isNotNull()).withColumn("_unit", F.col(self.unit).cast("string"))
        done = self.units(df.sparkSession)
        if done is not None:
            rows = rows.join(small_side(checkpointed(done)), "_unit", "left_anti")
        sketches(rows, [*self.keys, "_unit"], self.value, self.k).write.mode("append").partitionBy("_unit").parquet(self.path)

    def merged(self, spark: SparkSession, keys: Sequence[str]) -> DataFrame:
        return merge_sketches(spark.read.parquet(self.path), keys, self.k)


def sketch_quantile(sketch: Column | str, quantile: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(quantile))


def bracket_cuts(quantiles: Sequence[float], accuracy: int) -> list[float]:
    """Shares on either side of every quantile, farther from it than a sketch may be off."""
    margin = 2.0 / accuracy
    return [p for q in sorted(quantiles) for p in (max(0.0, q - margin), min(1.0, q + margin))]


def quantile_brackets(df: DataFrame, keys: Sequence[str], value: str, quantiles: Sequence[float],
                      accuracy: int = 1000) -> DataFrame:
    """Per group, a low and a high cut around every quantile.

    One pass; the result has one row per group and is written to the shared folder, so it is
    neither computed twice nor lost with an executor.
    """
    cuts = F.percentile_approx(value, bracket_cuts(quantiles, accuracy), accuracy)
    return checkpointed(df.groupBy(*keys).agg(cuts.alias("_cuts")))


def rank_summary(df: DataFrame, keys: Sequence[str], value: str, brackets: DataFrame, pairs: int) -> DataFrame:
    """Groups reduced to value ranges in order: keys, segment, lo, hi, n, total and squared spread.

    A value inside one of the ``pairs`` brackets keeps a row of its own; all values between two
    brackets share one, and so do the nulls. Segments are the brackets (odd) and the gaps around
    them (even). The summary is written to the shared folder, since several passes read it.
    """
    v = F.col(value)
    inside = F.lit(False)
    above = F.lit(0)
    for j in range(pairs):
        inside = inside | v.between(F.col("_cuts")[2 * j], F.col("_cuts")[2 * j + 1])
        above = above + (v > F.col("_cuts")[2 * j + 1]).cast("int")
    placed = df.join(small_side(brackets), list(keys)).select(
        *keys, v.alias("_v"), above.alias("_gap"), F.when(inside, v).alias("_point")
    )
    segment = 2 * F.col("_gap") + F.col("_point").isNotNull().cast("int")
    return checkpointed(
        placed.groupBy(*keys, "_gap", "_point")
        .agg(
            F.min("_v").alias("lo"),
            F.max("_v").alias("hi"),
            F.count(F.lit(1)).alias("n"),
            F.sum("_v").alias("total"),
            (F.var_pop("_v") * F.count("_v")).alias("spread"),
        )
        .withColumn("_segment", segment)
        .drop("_gap", "_point")
    )


def _ranks(quantiles: Sequence[float]) -> Column:
    """The ranks (from 0) between which the wanted quantiles of ``_all`` values lie."""
    position = lambda q: (F.col("_all") - 1) * F.lit(float(q))
    ranks = F.array(*[f(position(q)).cast("long") for q in quantiles for f in (F.floor, F.ceil)])
    return F.array_distinct(F.filter(ranks, lambda r: r.isNotNull()))


def narrowed(summary: DataFrame, keys: Sequence[str], quantiles: Sequence[float], bound: int = POINTS, cells: int = CELLS) -> DataFrame:
    """The summary with at most ``bound`` rows a group, the values at the wanted ranks still on rows of their own.

    As long as a group has more, every segment is cut into ``2 * cells + 1`` ranges of values, the values in each are
    counted, the ranges before a rank give its place, and only ranges that hold a wanted rank keep their values. A task
    adds up, and orders no more than the ranges of a group.
    """
    if bound < 6 * len(quantiles) + 2:
        raise ValueError("the bound leaves no room for the wanted values and what lies between them")
    grid, width = [i / cells for i in range(cells + 1)], 2 * cells + 4
    while (summary.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) > bound:
        known = summary.filter(F.col("lo").isNotNull())
        place = [*keys, "_segment"]
        cuts = checkpointed(known.groupBy(*place).agg(F.percentile_approx("lo", grid, 10 * cells).alias("_grid")))
        below = F.size(F.filter("_grid", lambda c: c < F.col("lo")))
        cell = (2 * below + F.array_contains("_grid", F.col("lo")).cast("int")).cast("long")
        placed = known.join(small_side(cuts), place).withColumn("_segment", F.col("_segment") * width + cell).drop("_grid")
        counts = placed.groupBy(*place).agg(F.sum("n").alias("n"), F.min("lo").alias("lo")).groupBy(*keys).agg(
            F.sort_array(F.collect_list(F.struct("lo", "_segment", "n"))).alias("_list"), F.sum("n").alias("_all"))
        sum_to = lambda rows, i, of: F.aggregate(F.slice(rows, F.lit(1), i), F.lit(0).cast("long"), lambda t, x: t + of(x))
        ranges = F.transform("_list", lambda x, i: F.struct(
            x["_segment"].alias("_segment"), sum_to("_list", i, lambda y: y["n"]).alias("b"), x["n"].alias("n")))
        holds = lambda x: F.exists("_ranks", lambda r: (x["b"] <= r) & (r < x["b"] + x["n"]))
        marked = F.transform("_begins", lambda x: F.struct(x["_segment"].alias("_segment"), holds(x).cast("long").alias("held")))
        # Ranges that hold a wanted rank are odd again, and all between two of them are one even segment.
        renumbered = F.transform("_held", lambda x, i: F.struct(
            x["_segment"].alias("_segment"), (x["held"] == 1).alias("_wanted"),
            (2 * sum_to("_held", i, lambda y: y["held"]) + x["held"]).alias("_next")))
        held = counts.withColumn("_ranks", _ranks(quantiles)).withColumn("_begins", ranges).withColumn("_held", marked)
        wanted = checkpointed(held.select(*keys, F.explode(renumbered).alias("x")).select(*keys, "x.*"))
        point = F.when(F.col("_wanted"), F.col("lo"))
        merged = placed.join(small_side(wanted), place).drop("_segment").withColumnRenamed("_next", "_segment").groupBy(
            *place, point.alias("_point")).agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"), F.sum("total").alias("total"),
            F.sum(F.col("spread") + F.col("total") * F.col("total") / F.col("n")).alias("_squares"))
        spread = F.greatest(F.lit(0.0), F.col("_squares") - F.col("total") * F.col("total") / F.col("n"))
        summary = checkpointed(merged.withColumn("spread", F.when(F.col("lo") == F.col("hi"), 0.0).otherwise(spread)).select(
            *summary.columns).unionByName(summary.filter(F.col("lo").isNull())))
    return summary


def _value_at(rank: Column) -> Column:
    """The value with this rank in the ordered rows of a group; inside a row of several values it is not known."""
    state = F.struct(F.lit(0).cast("long").alias("end"), F.lit(None).cast("double").alias("value"))

    def step(s: Column, x: Column) -> Column:
        inside = rank - s["end"]
        value = F.when((x["lo"] == x["hi"]) | (inside == 0), x["lo"]).when(inside == x["n"] - 1, x["hi"]).otherwise(
            F.raise_error(F.lit("quantile outside its bracket")).cast("double"))
        here = (inside >= 0) & (inside < x["n"])
        return F.struct((s["end"] + x["n"]).alias("end"), F.when(here, value).otherwise(s["value"]).alias("value"))

    return F.aggregate("_rows", state, step, lambda s: s["value"])


def describe(summary: DataFrame, keys: Sequence[str], quantiles: Sequence[float], bound: int = POINTS) -> DataFrame:
    """Every group's exact statistics from its rank summary.

    Columns: keys, n, nulls, mean, std (sample), min, max and the linearly interpolated ``quantiles`` as an array in the
    given order. A rank that falls between two brackets fails the job rather than giving a wrong value.
    """
    known = F.col("lo").isNotNull()
    rows = F.sort_array(F.collect_list(F.when(known, F.struct("lo", "hi", "n", "total", "spread"))))
    groups = narrowed(summary, keys, quantiles, bound).groupBy(*keys).agg(
        rows.alias("_rows"), F.sum(F.when(known, F.col("n"))).alias("_all"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("nulls"),
        F.sum("total").alias("_total"), F.min("lo").alias("min"), F.max("hi").alias("max"))
    groups = groups.withColumn("mean", F.col("_total") / F.col("_all")).withColumn(
        "_values", F.map_from_entries(F.transform(_ranks(quantiles), lambda r: F.struct(r, _value_at(r)))))
    squares = F.aggregate("_rows", F.lit(0.0), lambda t, x: t + x["spread"] + x["n"] * (x["total"] / x["n"] - F.col("mean"))
                          * (x["total"] / x["n"] - F.col("mean")))

    def between(q: float) -> Column:
        position = (F.col("_all") - 1) * F.lit(float(q))
        low, high = F.col("_values")[F.floor(position)], F.col("_values")[F.ceil(position)]
        return low + (high - low) * (position - F.floor(position))

    return groups.select(
        *keys, F.coalesce("_all", F.lit(0)).alias("n"), "nulls", "mean",
        F.when(F.col("_all") > 1, F.sqrt(squares / (F.col("_all") - 1))).alias("std"), "min", "max",
        F.when(F.col("_all") > 0, F.array(*map(between, quantiles))).alias("quantiles"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: Sequence[float],
                    accuracy: int = 1000, bound: int = POINTS) -> DataFrame:
    """Exact linearly interpolated quantiles per group, as an array; null for all-null groups."""
    brackets = quantile_brackets(df, keys, value, quantiles, accuracy)
    summary = rank_summary(df, keys, value, brackets, len(quantiles))
    return describe(summary, keys, quantiles, bound).select(*keys, "quantiles")


def rank_error(df: DataFrame, keys: Sequence[str], value: str, found: DataFrame,
               quantile: float, estimate: str) -> DataFrame:
    """How far an estimated quantile's rank is from the wanted one, as a share of the group.

    Zero if the wanted rank lies within the run of values equal to the estimate.
    """
    marked = df.filter(F.col(value).isNotNull()).join(small_side(checkpointed(found)), list(keys))
    shares = marked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col(value) < F.col(estimate)).cast("double")).alias("_below"),
        F.avg((F.col(value) <= F.col(estimate)).cast("double")).alias("_upto"),
    )
    error = F.greatest(F.col("_below") - quantile, quantile - F.col("_upto"), F.lit(0.0))
    return shares.select(*keys, "n", error.alias("rank_error"))

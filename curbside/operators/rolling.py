"""Trailing-window statistics over event time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

from curbside.functions.columns import finite
from curbside.session import checkpointed, small_side

# Attributes of the rolling statistics.
ATTRIBUTES = ("distance_miles", "fare_usd", "tip_usd")

# Panes that a trailing window is cut into; divides any whole number of seconds.
BLOCKS = 64


def usable(events: DataFrame, values: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """Drop events without any attribute; a single missing attribute counts as zero."""
    cleaned = events.withColumns({v: finite(F.col(v)) for v in values})
    some = cleaned.filter(F.coalesce(*[F.col(v) for v in values]).isNotNull())
    return some.withColumns({v: F.coalesce(F.col(v), F.lit(0.0)) for v in values})


def window_stats(values: Sequence[str] = ATTRIBUTES) -> list[Column]:
    """Event count, mean and population deviation of every attribute."""
    stats = [F.count(F.lit(1)).alias("n")]
    for v in values:
        stats += [F.avg(v).alias(f"{v}_mean"), F.stddev_pop(v).alias(f"{v}_std")]
    return stats


def trailing_stats(events: DataFrame, key: str, ts: str, window_seconds: int,
                   values: Sequence[str] = ATTRIBUTES, keep: Sequence[str] = (), blocks: int = BLOCKS) -> DataFrame:
    """For every event, statistics of its key over ``[t - window, t]``, both ends included.

    A window is cut into ``blocks`` panes. A trailing window is then the head of its own pane up to t, the whole panes
    before it, and the tail of the pane a window earlier from t - window on. The head is a running aggregate forwards; the
    tail is a running aggregate backwards over the earlier pane's events moved one window ahead; whole panes are sums of a
    small table with a row per key and pane. So a key, and a busy window of one, is spread over as many tasks as it has
    panes, each event is touched a constant number of times, and nothing is subtracted from a running sum.
    """
    window = window_seconds * 1_000_000
    size = window // blocks
    if window % blocks:
        raise ValueError("blocks must divide the window")
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = usable(events, values).filter(F.col(key).isNotNull() & (F.col(key) != ""))
    placed = rows.select(
        key, ts, *keep, *values, F.explode(F.array(F.lit(0), F.lit(1))).alias("_shift"), micros.alias("_t")
    )
    placed = placed.withColumn("_t", F.col("_t") + F.col("_shift") * F.lit(window).cast("bigint"))
    placed = placed.withColumn("_pane", F.col("_t") - F.pmod("_t", F.lit(size).cast("bigint")))
    pane = Window.partitionBy(key, "_pane")
    ahead = pane.orderBy("_t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    back = pane.orderBy(F.col("_t").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)

    running = {}
    for side, shift, frame in (("head", 0, ahead), ("tail", 1, back)):
        mine = F.col("_shift") == shift
        running[f"_n_{side}"] = F.count(F.when(mine, 1)).over(frame)
        for v in values:
            running[f"_{v}_m_{side}"] = F.avg(F.when(mine, F.col(v))).over(frame)
            running[f"_{v}_v_{side}"] = F.var_pop(F.when(mine, F.col(v))).over(frame)
    current = placed.withColumns(running).filter(F.col("_shift") == 0)
    current = current.join(_whole_panes(rows, key, micros, size, window, values), [key, "_pane"], "left")

    n_of = {side: F.coalesce(F.col(f"_n_{side}"), F.lit(0)) for side in ("head", "tail", "whole")}
    n = n_of["head"] + n_of["tail"] + n_of["whole"]
    out = [n.alias("n")]
    for v in values:
        part = lambda what, side: F.coalesce(F.col(f"_{v}_{what}_{side}"), F.lit(0.0))  # noqa: B023, E731
        mean = reduce(add, (n_of[s] * part("m", s) for s in n_of)) / n
        spread = (n_of[s] * (part("v", s) + (part("m", s) - mean) * (part("m", s) - mean)) for s in n_of)
        out += [mean.alias(f"{v}_mean"), F.sqrt(reduce(add, spread) / n).alias(f"{v}_std")]
    return current.select(key, ts, *keep, *out)


def _whole_panes(rows: DataFrame, key: str, micros: Column, size: int, window: int, values: Sequence[str]) -> DataFrame:
    """(key, pane): count, means and variances of the panes between the one a window earlier and this one.

    Panes are summed first; the running sums go over panes, in stretches of a window with the stretch before.
    """
    moments = [F.count(F.lit(1)).alias("_n")]
    for v in values:
        moments += [F.avg(v).alias(f"_{v}_m"), F.var_pop(v).alias(f"_{v}_v")]
    at = micros - F.pmod(micros, F.lit(size).cast("bigint"))
    panes = rows.groupBy(key, at.alias("_pane")).agg(*moments)
    own = F.col("_pane") - F.pmod("_pane", F.lit(window).cast("bigint"))
    near = panes.select("*", F.explode(F.array(own, own + window)).alias("_stretch"))
    # The frame begins after the pane a window earlier and ends before the pane itself.
    frame = Window.partitionBy(key, "_stretch").orderBy("_pane").rangeBetween(size - window, -size)
    n = F.sum("_n").over(frame)
    found = [n.alias("_n_whole")]
    for v in values:
        mean = F.sum(F.col("_n") * F.col(f"_{v}_m")).over(frame) / n
        squares = F.sum(F.col("_n") * (F.col(f"_{v}_v") + F.col(f"_{v}_m") * F.col(f"_{v}_m"))).over(frame) / n
        found += [mean.alias(f"_{v}_m_whole"), F.greatest(F.lit(0.0), squares - mean * mean).alias(f"_{v}_v_whole")]
    return near.withColumn("_mine", own == F.col("_stretch")).select(key, "_pane", "_mine", *found).filter("_mine").drop("_mine")


def latest_stats(events: DataFrame, key: str, ts: str, window_seconds: int,
                 values: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """Per key, statistics of the window that ends at its last event: two small aggregates."""
    rows = usable(events, values).filter(F.col(key).isNotNull())
    last = checkpointed(rows.groupBy(key).agg(F.max(ts).alias("last_ts")))
    width = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(window_seconds))
    live = rows.join(small_side(last), key).filter(F.col(ts) >= F.col("last_ts") - width)
    return live.groupBy(key, "last_ts").agg(*window_stats(values))

"""Time, cast, mapping and masking expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F, types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


def mask(value: Column, condition: Column) -> Column:
    """Null where the condition is true; a null condition keeps the value."""
    return F.when(condition, None).otherwise(value)


def period_start(ts: Column, unit: str) -> Column:
    """Start of the hour, day, week (Monday), month, quarter or year, without zone arithmetic."""
    day = F.to_date(ts)
    if unit == "hour":
        return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))
    if unit == "day":
        return day.cast("timestamp_ntz")
    return F.trunc(day, unit).cast("timestamp_ntz")


def week_start(ts: Column, first_weekday: int = 0) -> Column:
    """Start of the week that begins on ``first_weekday`` (0 = Monday)."""
    shifted = F.date_sub(F.to_date(ts), first_weekday)
    return F.date_add(F.trunc(shifted, "week"), first_weekday).cast("timestamp_ntz")


def _exact_seconds(start: Column, end: Column) -> Column:
    """Elapsed seconds with microseconds as a decimal; no zone arithmetic."""
    return (end - start).cast("interval second").cast("decimal(18,6)")


def seconds_between(start: Column, end: Column) -> Column:
    return _exact_seconds(start, end).cast("double")


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def epoch_millis(ts: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(_exact_seconds(epoch, ts) * 1000).cast("bigint")


def iso_format(ts: Column) -> Column:
    """ISO 8601 text; the fraction appears only when it is not zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_format(ts, "SSSSSS") == "000000", whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def iso_parse(text: Column) -> Column:
    """Naive timestamp, null where the text is not one."""
    return text.try_cast("timestamp_ntz")


def finite(value: Column) -> Column:
    """Double value with NaN turned into null."""
    as_double = value.cast("double")
    return F.when(~F.isnan(as_double), as_double)


def map_values(value: Column, mapping: Mapping, keep_unmapped: bool = False) -> Column:
    """Replace values by a lookup table; unmapped ones become null or stay."""
    chain = None
    for old, new in mapping.items():
        chain = F.when(value == old, new) if chain is None else chain.when(value == old, new)
    if chain is None:
        return value if keep_unmapped else F.lit(None)
    return chain.otherwise(value) if keep_unmapped else chain


def yes_no(flag: Column) -> Column:
    """Y -> true, N or F -> false, anything else null."""
    return F.when(flag == "Y", True).when(flag.isin("N", "F"), False)


def safe_cast(value: Column, source: T.DataType, target: T.DataType, name: str = "value") -> Column:
    """Cast that fails the job instead of changing a value.

    Overflow, unparsable text, a fraction lost on the way to an integer and an integer a
    float cannot hold all raise, whatever the session's ANSI setting is.
    """
    if source == target:
        return value
    out = value.try_cast(target)
    lost = value.isNotNull() & out.isNull()
    if isinstance(source, _FRACTIONAL) and isinstance(target, _INTEGRAL):
        lost = lost | F.isnan(value) | (value != F.floor(value))
    if isinstance(source, _INTEGRAL) and isinstance(target, _FRACTIONAL):
        lost = lost | (out.try_cast("bigint") != value)
    message = f"{name}: value does not fit {target.simpleString()}"
    return F.when(lost, F.raise_error(F.lit(message)).cast(target)).otherwise(out)


def right_closed_bin(value: Column, edges: list[float]) -> Column:
    """Index of the bin ``(edges[i], edges[i + 1]]``; null outside all bins."""
    chain = F.when(value <= edges[0], None)
    for i, high in enumerate(edges[1:]):
        chain = chain.when(value <= high, i)
    return chain

"""Trip events: building them from trips, their JSON form, decoding, ordered replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curbside.functions.columns import epoch_millis, finite, iso_format, iso_parse, minutes_between
from curbside.operators.zones import with_boroughs

# Raw columns of the two replayed feeds, in event order.
EVENT_SOURCES = {
    "yellow": (
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID",
        "trip_distance", "fare_amount", "tip_amount",
    ),
    "fhvhv": (
        "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID",
        "trip_miles", "base_passenger_fare", "tips",
    ),
}
EVENT_TRIP_COLUMNS = ("pu_dt", "do_dt", "pu_locid", "do_locid", "distance_miles", "fare_usd", "tip_usd")

# Fields of the JSON event.
EVENT_FIELDS = (
    "dataset", "pu_dt", "do_dt", "pu_locid", "do_locid", "pu_borough", "do_borough",
    "distance_miles", "fare_usd", "tip_usd", "duration_minutes",
)
# Every field is read as text, so a wrong one costs its own value and not the event.
_WIRE = ", ".join(f"{name} string" for name in (*EVENT_FIELDS, "_bad"))


def topic_name(dataset: str, year: int, topic: str | None = None) -> str:
    return topic or f"{dataset}_trips_{year}"


def select_event_trips(raw: DataFrame, dataset: str, year: int | None = None) -> DataFrame:
    """The seven trip columns of an event, for pickups within one calendar year."""
    picked = raw.select(*[F.col(old).alias(new) for old, new in zip(EVENT_SOURCES[dataset], EVENT_TRIP_COLUMNS)])
    return in_year(picked.withColumn("dataset", F.lit(dataset)), year)


def in_year(trips: DataFrame, year: int | None) -> DataFrame:
    if year is None:
        return trips
    start, end = (F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz") for y in (year, year + 1))
    return trips.filter((F.col("pu_dt") >= start) & (F.col("pu_dt") < end))


def build_events(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """The eleven event fields, from batch or streaming trips with a dataset column."""
    amounts = {c: finite(F.col(c)) for c in ("distance_miles", "fare_usd", "tip_usd")}
    ids = {c: F.col(c).cast("int") for c in ("pu_locid", "do_locid")}
    named = with_boroughs(trips.withColumns(amounts | ids), zones)
    return named.withColumn("duration_minutes", minutes_between(F.col("pu_dt"), F.col("do_dt"))).select(
        *EVENT_FIELDS
    )


def encode_events(events: DataFrame) -> DataFrame:
    """Key, compact JSON value with explicit nulls, and event time in milliseconds."""
    times = {c: iso_format(F.col(c)) for c in ("pu_dt", "do_dt")}
    body = F.struct(*[(times[c] if c in times else F.col(c)).alias(c) for c in EVENT_FIELDS])
    return events.select(
        F.coalesce(F.col("pu_locid").cast("string"), F.col("dataset")).alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
        epoch_millis(F.col("pu_dt")).alias("event_ms"),
    )


def _parsed(messages: DataFrame) -> DataFrame:
    """The JSON values as one struct ``e``."""
    return messages.select(
        F.from_json("value", _WIRE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("e")
    )


def _bad() -> Column:
    return F.col("e").isNull() | F.col("e._bad").isNotNull()


def _typed(fields: DataFrame) -> DataFrame:
    """Numbers, ids and times of the fields read as text."""
    numbers = {c: finite(F.col(c).try_cast("double")) for c in ("distance_miles", "fare_usd", "tip_usd", "duration_minutes")}
    ids = {c: finite(F.col(c).try_cast("double")).try_cast("int") for c in ("pu_locid", "do_locid")}
    times = {c: iso_parse(F.col(c)) for c in ("pu_dt", "do_dt")}
    return fields.withColumns(numbers | ids | times)


def decode_events(messages: DataFrame, observe: str | None = "decoded_messages") -> DataFrame:
    """Events from JSON values; only messages that are no JSON objects are skipped.

    Numbers may come as text, and zone ids as 132.0; what is no finite number is null. The counts of
    good and bad messages are reported as query metrics under the name ``observe``.
    """
    parsed = _parsed(messages)
    if observe:
        parsed = parsed.observe(observe, F.count_if(~_bad()).alias("good"), F.count_if(_bad()).alias("bad"))
    return _typed(parsed.filter(~_bad()).select("e.*").drop("_bad"))


def decode_all(messages: DataFrame) -> DataFrame:
    """A row per message: the event of ``decode_events`` and ``good``, whether the message could be read.

    Without a filter on it each value is parsed once.
    """
    return _typed(_parsed(messages).select("e.*", (~_bad()).alias("good")).drop("_bad"))


def in_pickup_order(events: DataFrame, parts: int) -> DataFrame:
    """Globally ordered by pickup time over ``parts`` partitions, for replay."""
    return events.repartitionByRange(parts, "pu_dt").sortWithinPartitions("pu_dt")

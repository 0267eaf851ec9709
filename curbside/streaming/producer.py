"""The producing job: raw trips of one or more feeds become keyed messages, a topic per feed and year."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from curbside.streaming.events import build_events, encode_events, in_pickup_order, select_event_trips, topic_name


def produce(raw: Mapping[str, DataFrame], zones: DataFrame, year: int, publish: Callable[[DataFrame, str], None],
            topic: str | None = None, parts: int = 200) -> None:
    """Hand each feed's messages of one pickup year to ``publish(messages, topic)``.

    ``raw`` has raw trips by feed name. Messages are in pickup order over ``parts`` partitions, which a sink writes side
    by side; within a partition none overtakes another. A given ``topic`` takes the messages of all feeds.
    """
    for dataset, trips in raw.items():
        events = build_events(select_event_trips(trips, dataset, year), zones)
        publish(encode_events(in_pickup_order(events, parts)), topic_name(dataset, year, topic))

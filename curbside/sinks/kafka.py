"""Kafka sink. The connector jar comes from ``--packages``."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Producer settings.
PRODUCER = {"kafka.compression.type": "zstd", "kafka.linger.ms": "50", "kafka.acks": "all"}


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Write (key, value) rows to a topic. Event time travels inside the JSON value."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**PRODUCER)
        .save()
    )

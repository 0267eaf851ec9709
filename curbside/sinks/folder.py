"""Message sink without a broker: a folder per topic."""

from __future__ import annotations

from pyspark.sql import DataFrame


def publish(messages: DataFrame, folder: str, topic: str) -> None:
    """Append messages to a topic's folder; reading ``folder`` gives them with a ``topic`` column."""
    messages.write.mode("append").parquet(f"{folder}/topic={topic}")

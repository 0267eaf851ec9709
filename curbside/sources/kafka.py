"""Kafka source and its JSON decoding. The connector jar comes from ``--packages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_topics(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of (key, value, timestamp); progress lives in the query's checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
    )

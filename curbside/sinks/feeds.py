"""Repacking one raw feed: drifting monthly files in, fixed-size yearly files out."""

from __future__ import annotations

from pyspark.sql import SparkSession

from curbside.sinks.parquet import repack
from curbside.sources.feeds import FEED_START, PICKUP_COLUMN, ROWS_PER_FILE, feed_schema
from curbside.sources.generations import read_conformed


def repack_feed(spark: SparkSession, folder: str, dst: str, feed: str, rows_per_file: int | None = None) -> None:
    """Conform a feed's monthly files to its target schema and repack them by pickup year.

    Trips whose pickup year lies outside the feed's range get a partition of their own; reading
    with a time range leaves them out.
    """
    rows = read_conformed(
        spark, folder, f"{feed}_tripdata", FEED_START[feed], feed_schema(feed), PICKUP_COLUMN[feed]
    )
    repack(rows, dst, ["year"], rows_per_file or ROWS_PER_FILE[feed])

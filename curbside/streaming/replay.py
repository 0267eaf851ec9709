"""File-based replay: a folder that grows slice by slice stands in for a topic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from curbside.session import remove, scratch_path


def time_slices(events: DataFrame, ts: str, slices: int) -> list[DataFrame]:
    """The events cut into equal spans of event time, oldest first.

    They are written once, a folder per slice, so a slice reads no other's events. Events without a
    time are in no slice unless there is one alone.
    """
    if slices == 1:
        return [events]
    low, high = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("low", "high"))
    span = events.agg(F.min(ts).alias("low"), F.max(ts).alias("high")).select(low, high).first()
    at = F.unix_micros(F.col(ts).cast("timestamp")) - F.lit(span[0])
    width = max(1, -(-((span[1] or 0) - (span[0] or 0) + 1) // slices))
    path = scratch_path(events.sparkSession, "slices")
    events.withColumn("_slice", F.floor(at / width).cast("int")).write.partitionBy("_slice").parquet(path)
    written = events.sparkSession.read.schema(f"{events.schema.toDDL()}, _slice int").parquet(path)
    return [written.filter(F.col("_slice") == i).drop("_slice") for i in range(slices)]


def replay(spark: SparkSession, parts: list[DataFrame],
           start: Callable[[DataFrame, str], DataStreamWriter], files_per_trigger: int | None = None,
           timed: bool = False) -> None:
    """Append each part to a folder and run the query over what is new, from its checkpoint.

    ``start`` gets the stream and the checkpoint path and returns a configured writer. Every part is
    a separate run of the same query, so each one also restarts from the checkpoint. A part is one
    micro-batch unless ``files_per_trigger`` splits it; split parts lose their time order, so leave
    it out for queries with a watermark shorter than a part. With ``timed`` the writer has its own
    trigger, and a run is stopped once it has taken in all that is there.
    """
    folder, progress = scratch_path(spark, "replay"), scratch_path(spark, "progress")
    for part in parts:
        part.write.mode("append").parquet(folder)
        reader = spark.readStream.schema(part.schema)
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        stream = reader.parquet(folder)
        writer = start(stream, progress)
        if timed:
            query = writer.start()
            query.processAllAvailable()
            query.stop()
        else:
            writer.trigger(availableNow=True).start().awaitTermination()
    remove(spark, folder, progress)

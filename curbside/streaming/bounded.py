"""A bound on the messages that a stream takes in total, over all micro-batches and restarts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamWriter

from curbside.session import remove, scratch_path

_PROGRESS = "admitted long"


@dataclass
class BoundedIntake:
    """The first ``total`` messages of a stream, kept below ``path``.

    A micro-batch is let in whole as long as it fits; of the one that goes beyond the bound, its first messages by
    ``order`` are. How many each has let in is a table, so a restarted job goes on where it was, and a repeated
    micro-batch overwrites its own part. A message's place is its row in a sorted, staged file plus the rows of the files
    before it, so no task orders more than its range.
    """

    path: str
    total: int
    order: Sequence[str] = ("event_ms", "value")

    def admitted(self, spark: SparkSession, before: int | None = None) -> int:
        """Messages let in so far, or before a micro-batch."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/progress")
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return 0
        rows = spark.read.schema(f"{_PROGRESS}, batch long").parquet(f"{self.path}/progress")
        if before is not None:
            rows = rows.filter(F.col("batch") < before)
        return rows.agg(F.coalesce(F.sum("admitted"), F.lit(0))).first()[0]

    def reached(self, spark: SparkSession) -> bool:
        return self.admitted(spark) >= self.total

    def update(self, batch: DataFrame, number: int) -> None:
        """Let in what the bound leaves of one micro-batch."""
        spark = batch.sparkSession
        left, count = self.total - self.admitted(spark, number), 0
        if left > 0:
            stage = scratch_path(spark, "intake")
            batch.orderBy(*self.order).write.option("maxRecordsPerFile", 0).parquet(stage)
            staged = spark.read.schema(batch.schema).parquet(stage).select(
                "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
            count = staged.count()
            kept = staged
            if count > left:
                earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
                bases = staged.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows")).select(
                    "_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"))
                kept = staged.join(F.broadcast(bases), "_file").filter(F.col("_base") + F.col("_row") < left)
            kept.select(*batch.columns).write.mode("overwrite").parquet(f"{self.path}/messages/batch={number}")
            remove(spark, stage)
        # Messages first: a micro-batch that fails between the two is repeated and counts nothing twice.
        spark.createDataFrame([(min(count, max(left, 0)),)], _PROGRESS).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/progress/batch={number}")

    def writer(self, messages: DataFrame, checkpoint: str) -> DataStreamWriter:
        return messages.writeStream.foreachBatch(self.update).option("checkpointLocation", checkpoint)

    def run(self, writer: DataStreamWriter, spark: SparkSession, poll_seconds: int = 1) -> None:
        """Run a started stream until it ends or the bound is reached, whichever comes first."""
        query = writer.start()
        while not query.awaitTermination(poll_seconds):
            if self.reached(spark):
                query.stop()

    def messages(self, spark: SparkSession, schema: str) -> DataFrame:
        """What was let in."""
        return spark.read.schema(schema).parquet(f"{self.path}/messages").drop("batch")

"""Partitioned Parquet with an exact number of rows per file."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from curbside.session import checkpointed, remove, scratch_path, small_side

# Fixed value: compression level of repacked files.
ZSTD_LEVEL = 6
# A task fills as many small files as hold this many rows, while there are tasks enough for all cores.
TASK_ROWS = 500_000
TASKS_PER_CORE = 4


def repack(df: DataFrame, dst: str, keys: Sequence[str], rows_per_file: int, *,
           preprocess: Callable[[DataFrame], DataFrame] | None = None, level: int = ZSTD_LEVEL,
           max_tasks: int = 20_000) -> None:
    """Replace ``dst`` by hive-partitioned files of exactly ``rows_per_file`` rows.

    Only the last file of each partition value is smaller, every file is one row group, and rows
    with a null partition key are dropped.

    Every row gets its position within its key without a window over the data: the rows are staged
    as Parquet sorted by key, so a row's position is its row index in the staged file plus an offset
    that depends on (file, key) alone. Counting reads just the key columns. A key holding any share
    of the rows is spread over as many tasks as it fills files, and since staged files do not
    change, a lost executor cannot move rows between files.
    """
    spark = df.sparkSession
    keys = list(keys)
    if preprocess is not None:
        df = df.transform(preprocess)
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    stage = scratch_path(spark, "stage")
    # One staged file per task, known by the first part of its name (part-00017).
    staging = df.sortWithinPartitions(*keys).write.mode("overwrite").option("compression", "zstd")
    staging.option("maxRecordsPerFile", 0).parquet(stage)

    task = F.substring_index(F.col("_metadata.file_name"), "-", 2)
    staged = spark.read.parquet(stage).select("*", task.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    earlier = Window.partitionBy(*keys).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    runs = staged.groupBy("_file", *keys).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    runs = runs.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    per_key = runs.groupBy(*keys).agg(F.ceil(F.sum("_rows") / rows_per_file).alias("_files"))
    # One row per partition value.
    in_order = Window.partitionBy(F.lit(0)).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    bases = per_key.withColumn("_base", F.coalesce(F.sum("_files").over(in_order), F.lit(0)))
    plan = checkpointed(runs.join(bases, keys).drop("_rows"))

    total = plan.agg(F.max(F.col("_base") + F.col("_files"))).first()[0] or 0
    files_per_task = files_a_task(total, rows_per_file, spark.sparkContext.defaultParallelism, max_tasks)
    tasks = max(1, -(-total // files_per_task))
    position = F.col("_before") + F.col("_row") - F.col("_first")
    numbered = staged.join(small_side(plan), ["_file", *keys]).withColumn(
        "_out", F.col("_base") + F.floor(position / rows_per_file)
    )
    placed = (
        numbered.repartitionById(tasks, F.floor(F.col("_out") / files_per_task).cast("int"))
        .sortWithinPartitions(*keys, "_out")
        .drop("_file", "_row", "_first", "_before", "_files", "_base", "_out")
    )
    (
        placed.write.mode("overwrite")
        .partitionBy(*keys)
        .option("partitionOverwriteMode", "static")
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", level)
        .option("parquet.block.size", 2**31 - 1)
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(dst)
    )
    remove(spark, stage)


def files_a_task(files: int, rows_per_file: int, cores: int, max_tasks: int) -> int:
    """How many files each task writes."""
    together = min(TASK_ROWS // rows_per_file, files // (TASKS_PER_CORE * cores))
    return max(1, together, -(-files // max_tasks))


def rebalance(df: DataFrame, dst: str, keys: Sequence[str], rows_per_file: int) -> None:
    """One-shuffle variant with files of at most ``rows_per_file`` rows, sized by AQE."""
    (
        df.dropna(subset=list(keys)).hint("rebalance", *keys)
        .write.mode("overwrite").partitionBy(*keys)
        .option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(dst)
    )


def file_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Rows per file of a partitioned table; no data column is read."""
    return (
        spark.read.parquet(path)
        .groupBy(*keys, F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )

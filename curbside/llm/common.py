"""Shared pieces: document keys, staged tables, Arrow helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from curbside.session import scratch_path


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text", prefix: str = "") -> list[Column]:
    """96 bits that stand for a text: equal texts have equal keys and equal results."""
    text = text_of(column)
    return [F.xxhash64(text).alias(f"{prefix}k1"), F.hash(text).alias(f"{prefix}k2")]


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None) -> tuple[DataFrame, str]:
    """The table written to the shared folder and read again: a lost executor recomputes nothing before it."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def numbered(df: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, int]:
    """The table with each row's ``position`` in the given order, from 0, and its number of rows.

    The rows are written sorted over all tasks; a position is the row's place in its file plus the rows of the files
    before it. No task sees more than its range of rows, or one row a file.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.orderBy(*order).write.option("maxRecordsPerFile", 0).parquet(path)
    own = spark.read.schema(df.schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    sizes = own.groupBy("_file").agg(F.count("*").alias("_rows"))
    bases = sizes.select("_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"))
    joined = own.join(F.broadcast(bases), "_file").withColumn("position", F.col("_base") + F.col("_at"))
    return joined.select(*df.columns, "position"), sizes.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove staged tables that are no longer read, and let Spark drop the shuffle files nothing refers to."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    spark._jvm.System.gc()


def map_arrow(df: DataFrame, work: Callable[[pa.RecordBatch], dict | None], schema: StructType | str) -> DataFrame:
    """mapInArrow for a function from one batch to columns by name."""
    spark_schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (columns := work(batch)) is not None:
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, spark_schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]

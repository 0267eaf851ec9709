"""One table in several file formats, their sizes and read times."""

from __future__ import annotations

import statistics
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from curbside.operators.profile import list_files
from curbside.sinks.parquet import ZSTD_LEVEL

# Format name -> (Spark source, write options).
FORMATS = {
    "parquet": ("parquet", {"compression": "zstd", "parquet.compression.codec.zstd.level": ZSTD_LEVEL}),
    "csv": ("csv", {"header": True}),
    "csv.gz": ("csv", {"header": True, "compression": "gzip"}),
    "orc": ("orc", {"compression": "zstd"}),
    "json": ("json", {}),
}


def write_formats(df: DataFrame, base: str, formats: Sequence[str] = tuple(FORMATS)) -> None:
    for name in formats:
        source, options = FORMATS[name]
        df.write.format(source).mode("overwrite").options(**options).save(f"{base}/{name}")


def read_format(spark: SparkSession, base: str, name: str, schema: T.StructType) -> DataFrame:
    source, options = FORMATS[name]
    reader = spark.read.format(source).schema(schema)
    return (reader.option("header", True) if "header" in options else reader).load(f"{base}/{name}")


def format_sizes(spark: SparkSession, base: str) -> DataFrame:
    """MiB per format, from the file listing."""
    listing = list_files(spark, base, "part-*")
    name = F.regexp_extract("path", r"/([^/]+)/part-[^/]*$", 1)
    return listing.groupBy(name.alias("name")).agg((F.sum("bytes") / float(2**20)).alias("size_mib"))


def read_times(spark: SparkSession, base: str, schema: T.StructType, formats: Sequence[str] = tuple(FORMATS),
               total_seconds: float = 10.0) -> list[tuple]:
    """Repeat full reads of every format for about ``total_seconds``: (name, mean ms, std ms, n)."""
    rows = []
    for name in formats:
        taken: list[float] = []
        while sum(taken) < total_seconds or len(taken) < 2:
            started = time.perf_counter()
            read_format(spark, base, name, schema).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        rows.append((name, statistics.mean(taken) * 1000, statistics.stdev(taken) * 1000, len(taken)))
    return rows


def format_report(spark: SparkSession, base: str, schema: T.StructType, total_seconds: float = 10.0) -> DataFrame:
    """Size and read time per format, smallest first."""
    times = spark.createDataFrame(
        read_times(spark, base, schema, total_seconds=total_seconds),
        "name string, t_ms_mean double, t_ms_std double, t_n int",
    )
    return format_sizes(spark, base).join(times, "name").orderBy("size_mib")

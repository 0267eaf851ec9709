"""Monthly files whose types drift, read into one target schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from curbside.operators.clean import conform, stack
from curbside.operators.profile import footers
from curbside.sources.feeds import from_start, month_columns

# Path of a month, which is one file or a folder of part files.
_MONTH_PATH = r"^(.*_\d{4}-\d{2}\.parquet)"


def generations(spark: SparkSession, folder: str, category: str, start: tuple[int, int]) -> list[list[str]]:
    """Paths of a category's months from the start month on, grouped by identical schema.

    Only month paths reach the driver; part files of a month have to agree on their types.
    """
    fields = footers(spark, f"{folder}/*{category}_????-??.parquet")
    found, year, month = month_columns(F.col("path"))
    wanted = fields.filter((found == category) & from_start(year, month, start))
    unit = F.regexp_extract("path", _MONTH_PATH, 1).alias("unit")
    distinct = wanted.select(unit, F.struct("field", "type").alias("field")).distinct()
    schemas = distinct.groupBy("unit").agg(F.sort_array(F.collect_list("field")).alias("fields"))
    grouped = schemas.groupBy("fields").agg(F.sort_array(F.collect_list("unit")).alias("units"))
    return [row["units"] for row in grouped.orderBy(F.col("units")[0]).collect()]


def read_conformed(spark: SparkSession, folder: str, category: str, start: tuple[int, int],
                   schema: T.StructType, pickup: str) -> DataFrame:
    """Read each generation with its own types, conform it, and stack the results."""
    found = generations(spark, folder, category, start)
    if not found:
        raise ValueError(f"no {category} files from {start} on in {folder}")
    return stack(conform(spark.read.parquet(*units), schema, pickup) for units in found)

"""Session conventions: UTC, shared scratch folder, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# A side is broadcast only after its rows and their bytes were checked against these bounds.
SMALL_ROWS, SMALL_BYTES = 200_000, 64 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Trip times are naive wall-clock values, so every session runs in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Quantile sketches per (label, fare bucket) are a few hundred groups: keep them hashed.
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "512")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A folder of our own is made only for a local master where the setting is absent.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="curbside-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/curbside/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage, so a lost executor costs no recompute."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: texts and binaries by their length, nested values by their JSON, others by their type."""
    known = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}
    total = F.lit(16)
    for field in df.schema.fields:
        column = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(column)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(F.struct(column)))
        else:
            size = F.lit(known.get(type(field.dataType), 16))
        total = total + F.coalesce(size, F.lit(0))
    return total.cast("long")


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> bool:
    """Whether the table has at most ``max_rows`` rows of ``max_bytes`` together; every partition counts its own."""
    rows, size = df.select(row_bytes(df).alias("size")).agg(F.count(F.lit(1)), F.sum("size")).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables through the file system that Hadoop has for them."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast hint if the table is small, else the table as it is.

    Beyond the bound the join stays a shuffle join, where AQE splits skewed partitions.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def lookup(df: DataFrame, side: DataFrame, key: str, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Left join of a lookup table with unique keys.

    A small table is broadcast. With a large one, rows whose key is null go around the join: they
    find nothing, and would otherwise all meet in one task.
    """
    columns = [*df.columns, *[c for c in side.columns if c != key]]
    if is_small(side, max_rows):
        return df.join(F.broadcast(side), key, "left").select(*columns)
    known = df.filter(F.col(key).isNotNull()).join(side, key, "left").select(*columns)
    return known.unionByName(df.filter(F.col(key).isNull()), allowMissingColumns=True)

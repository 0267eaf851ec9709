import glob
import math
import os
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from curbside.sinks import formats
from curbside.sinks.parquet import file_rows, files_a_task, rebalance, repack


def check_layout(spark, path, keys, rows_per_file, want):
    """Every key's files are full but one, and rows in equal rows out."""
    sizes = {}
    for r in file_rows(spark, path, keys).collect():
        sizes.setdefault(tuple(r[k] for k in keys), []).append(r["rows"])
    for key, found in sizes.items():
        total = sum(1 for row in want.elements() if row[:len(keys)] == key)
        assert sum(found) == total
        assert len(found) == math.ceil(total / rows_per_file), key
        assert sum(1 for n in found if n != rows_per_file) <= 1, key
    columns = [*keys, *sorted(c for c in spark.read.parquet(path).columns if c not in keys)]
    got = Counter(tuple(r) for r in spark.read.parquet(path).select(columns).collect())
    assert got == want
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        assert meta.num_row_groups == 1
        assert meta.row_group(0).column(0).compression == "ZSTD"
        assert not set(keys) & set(pq.ParquetFile(file).schema_arrow.names)


def test_five_rows_over_two_keys(spark, tmp_path):
    rows = [(1, "a", 1), (1, "a", 2), (2, "a", 3), (2, "b", 4), (1, "b", 5)]
    df = spark.createDataFrame(rows, "x long, y string, z long").repartition(3)
    dst = str(tmp_path / "out")
    repack(df, dst, ["x", "y"], 5)
    check_layout(spark, dst, ["x", "y"], 5, Counter(rows))


@pytest.mark.parametrize("max_tasks", [20_000, 3])
def test_hot_key_null_keys_and_exact_sizes(spark, tmp_path, max_tasks):
    df = spark.range(0, 10_007, numPartitions=13).select(
        F.when(F.col("id") % 101 == 0, None).when(F.col("id") % 3 == 0, 2020).otherwise(2000 + F.col("id") % 7).cast("int").alias("year"),
        F.col("id").alias("v"),
    )
    dst = str(tmp_path / "out")
    repack(df, dst, ["year"], 100, max_tasks=max_tasks)
    want = Counter(tuple(r) for r in df.filter("year is not null").collect())
    check_layout(spark, dst, ["year"], 100, want)


def test_small_files_share_tasks(spark, tmp_path):
    """A task costs more than a small file; files of 100 rows are written several to a task, on all cores."""
    df = spark.range(0, 40_000, numPartitions=4).select((F.col("id") % 3).cast("int").alias("year"), F.col("id").alias("v"))
    dst = str(tmp_path / "out")
    repack(df, dst, ["year"], 100)
    check_layout(spark, dst, ["year"], 100, Counter(tuple(r) for r in df.collect()))
    names = [os.path.basename(f) for f in glob.glob(f"{dst}/**/*.parquet", recursive=True)]
    tasks = {name.split("-")[1] for name in names}
    cores = spark.sparkContext.defaultParallelism
    assert len(names) == 402 and cores <= len(tasks) <= 8 * cores < 402
    assert files_a_task(100_000, 2000, 12, 20_000) == 250 and files_a_task(100, 2_000_000, 1, 20_000) == 1


def test_destination_is_replaced_and_preprocess_runs(spark, tmp_path):
    dst = str(tmp_path / "out")
    repack(spark.range(10).withColumn("k", F.lit(1)), dst, ["k"], 4)
    repack(spark.range(6).withColumn("k", F.lit(2)), dst, ["k"], 4, preprocess=lambda d: d.filter("id < 5"))
    assert sorted((r.k, r["rows"]) for r in file_rows(spark, dst, ["k"]).collect()) == [(2, 1), (2, 4)]


def test_empty_input(spark, tmp_path):
    dst = str(tmp_path / "out")
    repack(spark.range(5).withColumn("k", F.lit(None).cast("int")), dst, ["k"], 4)
    assert glob.glob(f"{dst}/**/*.parquet", recursive=True) == []


def test_rebalance_keeps_rows(spark, tmp_path):
    dst = str(tmp_path / "out")
    rebalance(spark.range(1000).withColumn("k", F.col("id") % 2), dst, ["k"], 100)
    assert sum(r["rows"] for r in file_rows(spark, dst, ["k"]).collect()) == 1000
    assert max(r["rows"] for r in file_rows(spark, dst, ["k"]).collect()) <= 100


def test_formats_read_back_the_same_rows(spark, sf, tmp_path):
    from curbside.plans import registry

    table = registry._formats_table(spark, sf)
    base = str(tmp_path)
    formats.write_formats(table, base)
    want = Counter(tuple(r) for r in table.collect())
    for name in formats.FORMATS:
        assert Counter(tuple(r) for r in formats.read_format(spark, base, name, table.schema).collect()) == want, name
    report = formats.format_report(spark, base, table.schema, total_seconds=0.01).collect()
    assert {r.name for r in report} == set(formats.FORMATS) and all(r.t_n >= 2 for r in report)
    assert [r.size_mib for r in report] == sorted(r.size_mib for r in report)

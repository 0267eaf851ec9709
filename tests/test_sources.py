from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from curbside.operators import profile
from curbside.plans import views
from curbside.sources import feeds
from curbside.sources.generations import generations, read_conformed


def test_month_of_name():
    assert feeds.month_of_name("/x/yellow_tripdata_2024-07.parquet") == (2024, 7)
    with pytest.raises(ValueError):
        feeds.month_of_name("yellow_tripdata_2024-7.parquet")


def test_month_files_and_rows_as_plain_files(spark, tmp_path):
    import pandas as pd

    for name in ("green_tripdata_2013-12", "green_tripdata_2014-01", "green_tripdata_2014-02", "fhv_tripdata_2014-02"):
        pd.DataFrame({"v": [1, 2]}).to_parquet(tmp_path / f"{name}.parquet")
    files = feeds.month_files(spark, str(tmp_path), "green_tripdata", (2014, 1))
    assert sorted((r.src_year, r.src_month) for r in files.collect()) == [(2014, 1), (2014, 2)]
    rows = feeds.read_months(spark, str(tmp_path), "green_tripdata", (2014, 2))
    assert [tuple(r) for r in rows.distinct().orderBy("v").collect()] == [(1, 2014, 2), (2, 2014, 2)]


def test_bad_file_name_fails(spark, tmp_path):
    import pandas as pd

    pd.DataFrame({"v": [1]}).to_parquet(tmp_path / "green_tripdata_2o14-01.parquet")
    with pytest.raises(Exception, match="no year and month"):
        feeds.month_files(spark, str(tmp_path), "green_tripdata", (2014, 1)).collect()


def test_feed_scan_prunes_partitions_and_pushes_time(spark, sf, tmp_path):
    path = str(tmp_path / "feed")
    rows = views.trips_raw(spark, sf).withColumn("year", F.year("pu_dt"))
    rows.write.partitionBy("year").parquet(path)
    out = feeds.read_feed(spark, path, "pu_dt", datetime(1996, 1, 1), datetime(1998, 1, 1))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "year#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "GreaterThanOrEqual(pu_dt" in plan and "LessThan(pu_dt" in plan
    assert [r.year for r in out.select("year").distinct().orderBy("year").collect()] == [1996, 1997]
    one = feeds.read_partition(spark, path, "year", 1997)
    assert "year" not in one.columns
    assert one.count() == rows.filter("year = 1997").count()


def test_location_columns_are_renamed(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`PU_locationID` int, DOLocationID int, x int")
    assert feeds.normalise_location_names(df).columns == ["pulocationid", "dolocationid", "x"]


def test_zones_and_csv(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('OBJECTID,zone,borough\n1,"Newark, Airport",EWR\n2,Jamaica,Queens\n')
    assert [tuple(r) for r in feeds.read_zones(spark, str(path)).collect()] == [
        (1, "Newark, Airport", "EWR"), (2, "Jamaica", "Queens")]


def test_feed_view_reads_nested_folders(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t" / "a" / "b"))
    feeds.feed_view(spark, str(tmp_path / "t"), "nested_feed")
    assert spark.sql("SELECT count(*) AS n FROM nested_feed").first().n == 3
    spark.catalog.dropTempView("nested_feed")


def test_generations_are_read_with_their_own_types(spark, tmp_path):
    base = str(tmp_path / "m")
    spark.sql("SELECT TIMESTAMP_NTZ'2015-01-02 00:00:00' AS pickup_datetime, 4D AS PUlocationID").write.parquet(
        f"{base}/fhv_tripdata_2015-01.parquet")
    spark.sql("SELECT TIMESTAMP_NTZ'2016-01-02 00:00:00' AS pickup_datetime, 5L AS PULocationID").write.parquet(
        f"{base}/fhv_tripdata_2016-01.parquet")
    spark.sql("SELECT 'x' AS other").write.parquet(f"{base}/fhv_tripdata_2014-01.parquet")
    assert [len(g) for g in generations(spark, base, "fhv_tripdata", (2015, 1))] == [1, 1]
    schema = T.StructType.fromDDL("pulocationid int, year int")
    out = read_conformed(spark, base, "fhv_tripdata", (2015, 1), schema, "pickup_datetime")
    assert sorted(tuple(r) for r in out.collect()) == [(4, 2015), (5, 2016)]
    with pytest.raises(ValueError, match="no fhv"):
        read_conformed(spark, base, "fhv_tripdata", (2030, 1), schema, "pickup_datetime")


def test_feed_is_repacked_from_raw_months(spark, sf, tmp_path):
    from curbside.sinks.feeds import repack_feed
    from curbside.sinks.parquet import file_rows

    rows = views.raw_feed(spark, sf, "yellow").drop("src_year")
    shifted = rows.withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime") + F.expr("INTERVAL '18' YEAR"))
    early = shifted.filter("year(tpep_pickup_datetime) < 2016").withColumn("passenger_count", F.col("passenger_count").cast("double"))
    late = shifted.filter("year(tpep_pickup_datetime) >= 2016").withColumnRenamed("pulocationid", "PULocationID")
    folder, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    for part in (early, late):
        unit = F.concat(F.lit("yellow_tripdata_"), F.date_format("tpep_pickup_datetime", "yyyy-MM"), F.lit(".parquet"))
        part.withColumn("unit", unit).write.mode("append").partitionBy("unit").parquet(folder)
    repack_feed(spark, folder, dst, "yellow", rows_per_file=100)
    sizes = [(r.year, r["rows"]) for r in file_rows(spark, dst, ["year"]).collect()]
    assert sum(n for _, n in sizes) == rows.count() and {n for _, n in sizes if n != 100} and max(n for _, n in sizes) == 100
    back = feeds.read_feed_default(spark, dst, "yellow")
    types = {f.name: f.dataType for f in feeds.feed_schema("yellow").fields}
    assert {f.name: f.dataType for f in back.schema.fields} == types
    assert back.count() == rows.count()


def test_footers_see_nulls_and_missing_statistics(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    table = pa.table({"a": [1, 2], "b": [1, None], "n": pa.nulls(2), "l": [[1], [2]]})
    pq.write_table(table, tmp_path / "x.parquet")
    pq.write_table(table.select(["a"]), tmp_path / "y.parquet", write_statistics=False)
    rows = profile.footers(spark, str(tmp_path))
    got = {(r.file, r.field): (r.type, r.has_nulls) for r in
           profile.schema_profile(rows, profile.file_name(F.col("path"))).collect()}
    assert got[("x.parquet", "a")] == ("int64", False)
    assert got[("x.parquet", "b")] == ("int64", True)
    assert got[("x.parquet", "n")] == ("null", True)
    assert got[("x.parquet", "l")][1] is False
    assert got[("y.parquet", "a")] == ("int64", True)


def test_histogram_measures_each_file_once(spark):
    measured = spark.sparkContext.accumulator(0)

    def sizes(batches):
        for rows in batches:
            measured.add(len(rows))
            yield rows.assign(source="m", path=rows["id"].astype(str), mib=rows["id"].astype(float))[["source", "path", "mib"]]

    rows = spark.range(30).mapInPandas(sizes, "source string, path string, mib double")
    assert [r.files for r in profile.histogram(rows).collect()] == [2] * 15
    assert measured.value == 30


def test_histogram_keeps_the_largest_in_the_last_bin(spark):
    df = spark.createDataFrame([("m", "a", 0.0), ("m", "b", 15.0), ("d", "c", 7.4)], "source string, path string, mib double")
    got = {(r.source, r.bin): r.files for r in profile.histogram(df).collect()}
    assert got == {("m", 0): 1, ("m", 14): 1, ("d", 7): 1}

"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from curbside.functions.columns import epoch_millis
from curbside.operators import anomaly, bases, clean, colstats, decay, evolution, money, profile
from curbside.operators import quantiles, rolling, volume, zones as zone_ops
from curbside.plans import views
from curbside.session import checkpointed, scratch_path
from curbside.sinks import feeds as feed_sink, folder as folder_sink, formats
from curbside.sinks.parquet import file_rows, repack
from curbside.sources import feeds
from curbside.sources.generations import read_conformed
from curbside.streaming import clusters, events
from curbside.streaming.bounded import BoundedIntake
from curbside.streaming.frozen import ClusterTable
from curbside.streaming.producer import produce
from curbside.streaming.replay import replay, time_slices
from curbside.streaming.report import ReportTable, cluster_job, report_job, rolling_rows
from curbside.streaming.rolling import RollingReport, sliding_stats

Query = Callable[[SparkSession, str], DataFrame]
BIG = bases.BIG_LICENSES
CONFORMED = (
    "vendorid int, passenger_count int, trip_distance float, fare_amount float, "
    "tpep_pickup_datetime timestamp_ntz, pulocationid int, year int"
)
SIX_HOURS = 6 * 3600
# Micro-batches of a replayed stream.
SLICES = 2
# The fixture's features lie close together; a smaller radius gives several micro-clusters.
TAU = 1.0


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})


def single(df: DataFrame, *columns: str) -> DataFrame:
    """Averages to single precision: engines add in different orders, and decimal rounding would
    fall apart on the many averages that end in an exact half."""
    return df.withColumns({c: F.col(c).cast("float").cast("double") for c in columns})


def _rolled(df: DataFrame) -> DataFrame:
    means = [f"{v}_mean" for v in rolling.ATTRIBUTES]
    return rounded(single(df, *means), *[f"{v}_std" for v in rolling.ATTRIBUTES], places=8)


def _big_bases(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.trips_raw(spark, sf)
    return bases.big_bases(views.feed(raw, "fhv"), views.feed(raw, "fhvhv"), BIG, "month", views.LAST_SEEN)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return bases.label_stacked(views.trips(spark, sf), _big_bases(spark, sf))


def _priced(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled trips of the feeds that have fares; their labels need no base table."""
    rows = views.feed(views.trips(spark, sf), "yellow", "green", "fhvhv")
    app = F.when(F.col("licensenum").isin(*BIG), "fhv_big").otherwise("fhv_small")
    app = F.when(F.col("licensenum").isNotNull(), app)
    return rows.withColumn("label", F.when(F.col("dataset") == "fhvhv", app).otherwise(F.col("dataset")))


# --- sources and sinks -------------------------------------------------------------------


def src_month_files(spark, sf):
    folder = scratch_path(spark, "months")
    views.monthly_units(spark, sf, "yellow", folder)
    found = feeds.month_files(spark, folder, "yellow_tripdata", (1998, 1))
    return found.select("category", "src_year", "src_month").distinct()


def src_month_rows(spark, sf):
    folder = scratch_path(spark, "months")
    views.monthly_units(spark, sf, "yellow", folder)
    rows = feeds.read_months(spark, folder, "yellow_tripdata", (1998, 1))
    return rows.groupBy("src_year", "src_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("passenger_count").alias("passengers")
    )


def _repacked(spark, sf, rows_per_file: int = 5000) -> str:
    dst = scratch_path(spark, "feed")
    year = F.when(F.col("do_locid") != 0, F.year("pu_dt"))
    repack(views.trips_raw(spark, sf).drop("src_year").withColumn("year", year), dst, ["year"], rows_per_file)
    return dst


def src_feed_scan(spark, sf):
    rows = feeds.read_feed(spark, _repacked(spark, sf), "pu_dt", views.READ_START, views.SPLIT)
    counted = rows.groupBy("year", "dataset").agg(
        F.count(F.lit(1)).alias("n"), F.min("pu_dt").alias("first_dt"), F.max("pu_dt").alias("last_dt")
    )
    return counted


def src_partition_read(spark, sf):
    return feeds.read_partition(spark, _repacked(spark, sf), "year", 2000)


def sink_repartition(spark, sf):
    files = file_rows(spark, _repacked(spark, sf), ["year"])
    return files.groupBy("year").agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("rows") == 5000).alias("full_files"),
        F.min("rows").alias("smallest"),
        F.sum("rows").alias("rows"),
    )


def _formats_table(spark, sf) -> DataFrame:
    rows = views.raw_feed(spark, sf, "green")
    return rows.filter(F.year("lpep_pickup_datetime") == 2000).drop("src_year")


def sink_format_matrix(spark, sf):
    table, base = _formats_table(spark, sf), scratch_path(spark, "formats")
    formats.write_formats(table, base)
    read = []
    for name in formats.FORMATS:
        back = formats.read_format(spark, base, name, table.schema)
        read.append(back.agg(
            F.lit(name).alias("format"),
            F.count(F.lit(1)).alias("n"),
            F.sum("pulocationid").alias("sum_pu"),
            F.sum("passenger_count").alias("sum_passengers"),
            F.round(F.sum(F.col("trip_distance").cast("double")), 3).alias("sum_distance"),
            F.min("lpep_pickup_datetime").alias("first_dt"),
            F.max("lpep_dropoff_datetime").alias("last_dt"),
            F.count("payment_type").alias("n_payment"),
        ))
    return clean.stack(read)


def format_report(spark, sf):
    table, base = _formats_table(spark, sf), scratch_path(spark, "formats")
    formats.write_formats(table, base)
    return formats.format_report(spark, base, table.schema)


def repack_feed(spark, sf):
    """Every feed's drifting monthly files, from its start month on, in files of a thousandth of its usual rows."""
    found = []
    for name in feeds.FEEDS:
        folder, dst, size = scratch_path(spark, "drifting"), scratch_path(spark, "repacked"), feeds.ROWS_PER_FILE[name] // 1000
        views.drifting_units(spark, sf, name, folder)
        feed_sink.repack_feed(spark, folder, dst, name, size)
        found.append(file_rows(spark, dst, ["year"]).groupBy("year").agg(
            F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("files"),
            F.count_if(F.col("rows") == size).alias("full_files"), F.sum("rows").alias("rows")))
    return clean.stack(found)


def feed_sql_view(spark, sf):
    """A repacked feed as a view over all files below its folder, asked in SQL."""
    feeds.feed_view(spark, _repacked(spark, sf), "curbside_feed")
    return spark.sql(
        "SELECT dataset, count(*) AS n, count(licensenum) AS licensed, min(pu_dt) AS first_dt FROM curbside_feed GROUP BY dataset")


def zone_load(spark, sf):
    """The zone table from CSV and from Parquet."""
    table = views.zones(spark, sf).select(F.col("locid").alias("OBJECTID"), "zone", "borough")
    base = scratch_path(spark, "zones")
    table.write.csv(f"{base}/zones.csv", header=True)
    table.write.parquet(f"{base}/zones.parquet")
    return clean.stack(feeds.read_zones(spark, f"{base}/zones.{kind}").withColumn("kind", F.lit(kind)) for kind in ("csv", "parquet"))


def src_csv(spark, sf):
    """Rows read back from CSV and gzipped CSV under a declared schema."""
    table = views.trips_raw(spark, sf).select("dataset", "pu_dt", "pu_locid", "passengers", "dbasenum")
    base, read = scratch_path(spark, "csv"), []
    for codec in ("none", "gzip"):
        table.write.csv(f"{base}/{codec}", header=True, compression=codec)
        read.append(feeds.read_csv(spark, f"{base}/{codec}", table.schema).withColumn("codec", F.lit(codec)))
    return clean.stack(read).groupBy("codec", "dataset").agg(
        F.count(F.lit(1)).alias("n"), F.sum("pu_locid").alias("sum_pu"), F.sum("passengers").cast("long").alias("sum_passengers"),
        F.count("dbasenum").alias("bases"), F.max("pu_dt").alias("last_dt"))


# --- profiling ---------------------------------------------------------------------------


def schema_profile(spark, sf):
    views.prepare(spark)
    return profile.schema_profile(profile.footers(spark, f"{sf}/*.parquet"), profile.file_name(F.col("path")))


def _history(spark, sf) -> str:
    folder = scratch_path(spark, "history")
    views.schema_history(spark, sf, folder)
    return folder


def _history_profile(spark, sf) -> DataFrame:
    return profile.schema_profile(profile.footers(spark, _history(spark, sf)), profile.month_unit(F.col("path")))


def schema_evolution(spark, sf):
    return evolution.schema_changes(_history_profile(spark, sf))


def schema_final(spark, sf):
    return evolution.final_schema(_history_profile(spark, sf))


def src_columns_union(spark, sf):
    return profile.columns_union(_history_profile(spark, sf))


def conform_schema(spark, sf):
    schema = T.StructType.fromDDL(CONFORMED)
    rows = read_conformed(spark, _history(spark, sf), "yellow_tripdata", (1995, 1), schema, "tpep_pickup_datetime")
    return rows.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("vendorid").alias("sum_vendor"),
        F.sum("passenger_count").alias("sum_passengers"),
        F.sum(F.col("trip_distance").cast("double")).alias("sum_distance"),
        F.max(F.col("fare_amount").cast("double")).alias("max_fare"),
        F.min("tpep_pickup_datetime").alias("first_dt"),
    )


def feed_bytes(spark, sf):
    views.prepare(spark)
    return profile.total_size(profile.list_files(spark, f"{sf}/*.parquet"), profile.file_name(F.col("path")).alias("file"))


def file_size_histogram(spark, sf):
    path = _repacked(spark, sf)
    sizes = profile.row_group_sizes(spark, path).unionByName(profile.memory_sizes(spark, path))
    return profile.histogram(sizes)


# --- cleaning ----------------------------------------------------------------------------


def universal_trips(spark, sf):
    frames = [
        clean.universal_trips(views.raw_feed(spark, sf, name)).withColumn("dataset", F.lit(name))
        for name in feeds.FEEDS
    ]
    stacked = clean.stack(frames)
    doubles = [f.name for f in stacked.schema.fields if isinstance(f.dataType, T.FloatType)]
    ints = [f.name for f in stacked.schema.fields if isinstance(f.dataType, (T.ByteType, T.ShortType))]
    return stacked.withColumns(
        {c: F.col(c).cast("double") for c in doubles} | {c: F.col(c).cast("int") for c in ints}
    )


def clean_zones(spark, sf):
    return clean.clean_zones(views.trips_raw(spark, sf)).select("dataset", "pu_dt", "pu_locid", "do_locid")


def clean_dropoff(spark, sf):
    return clean.clean_dropoff(views.trips_raw(spark, sf)).select("dataset", "pu_dt", "do_dt")


def clean_amounts(spark, sf):
    cleaned = clean.clean_amounts(views.trips_raw(spark, sf))
    return cleaned.select("dataset", "passengers", "distance", "fee_fare", "fee_tip", "fee_total")


def clean_base(spark, sf):
    return clean.clean_base(views.trips_raw(spark, sf)).select("dataset", "pu_dt", "dbasenum")


def trip_time(spark, sf):
    return clean.with_trip_time(views.trips(spark, sf)).select("dataset", "pu_dt", "do_dt", "trip_time")


def label_fhv(spark, sf):
    rows = views.feed(views.trips(spark, sf), "fhv")
    return bases.label_fhv(rows, _big_bases(spark, sf)).select("pu_dt", "dbasenum", "label")


def label_fhvhv(spark, sf):
    rows = views.feed(views.trips(spark, sf), "fhvhv")
    return bases.label_fhvhv(rows, BIG).select("pu_dt", "licensenum", "label")


def flag_to_bool(spark, sf):
    rows = clean.with_yes_no(views.raw_feed(spark, sf, "yellow"))
    return rows.select("tpep_pickup_datetime", "store_and_fwd_flag")


def location_names(spark, sf):
    """Zone columns under other spellings, brought to one."""
    rows = views.trips_raw(spark, sf).select("dataset", F.col("pu_locid").alias("PU_Location-ID"), F.col("do_locid").alias("DOlocationID"))
    return feeds.normalise_location_names(rows).groupBy("dataset", "pulocationid").agg(
        F.count(F.lit(1)).alias("n"), F.max("dolocationid").alias("last_do"))


def constant_label(spark, sf):
    rows = clean.with_label(views.feed(views.trips(spark, sf), "yellow"), "yellow")
    return rows.groupBy("label", "pu_locid").agg(F.count(F.lit(1)).alias("n"))


def pick_columns(spark, sf):
    """All columns of the anomaly counts but some."""
    return clean.pick(_anomalies("yellow")(spark, sf), drop=("time_zero", "fare_negative"))


# --- anomalies ---------------------------------------------------------------------------


def _anomalies(name: str) -> Query:
    def query(spark, sf):
        return anomaly.count_anomalies(
            views.raw_feed(spark, sf, name), anomaly.anomaly_flags("src_year", **anomaly.AUDIT_COLUMNS[name])
        )

    return query


def anomaly_fractions(spark, sf):
    frames = []
    for name in feeds.FEEDS:
        leave_out = ("year_out_of_range", "distance_negative") if name == "fhvhv" else ()
        shares = anomaly.anomaly_fractions(_anomalies(name)(spark, sf), leave_out=leave_out)
        frames.append(shares.withColumn("dataset", F.lit(name)))
    return rounded(clean.stack(frames), "fraction", places=9)


def _by_zone(spark, sf) -> DataFrame:
    flags = anomaly.anomaly_flags("src_year", "pu_dt", "do_dt", "pu_locid", "do_locid", "distance", "fee_fare")
    ends = anomaly.flagged_zone_ends(views.trips_raw(spark, sf), F.col("dataset"), flags, "pu_locid", "do_locid")
    return anomaly.anomalies_by_zone(ends)


def anomaly_by_zone(spark, sf):
    return _by_zone(spark, sf)


def anomaly_zone_rate(spark, sf):
    rates = anomaly.zone_error_rate(_by_zone(spark, sf))
    return rounded(zone_ops.zones_right_join(rates, views.zones(spark, sf)), "error_rate", places=9)


def anomaly_zone_top5(spark, sf):
    top = anomaly.top_zones_by_rate(anomaly.zone_error_rate(_by_zone(spark, sf)))
    return rounded(zone_ops.join_zone_names(top, views.zones(spark, sf)), "error_rate", places=9)


# --- joins -------------------------------------------------------------------------------


def join_zone_names(spark, sf):
    counts = volume.volume_by_zone(views.trips(spark, sf), "dataset")
    return zone_ops.join_zone_names(counts, views.zones(spark, sf))


def join_zone_names_twice(spark, sf):
    return zone_ops.join_zone_names_twice(volume.volume_by_arc(views.trips(spark, sf)), views.zones(spark, sf))


def join_zones_right(spark, sf):
    fares = single(money.fare_by_zone(views.trips(spark, sf)), "fare_mean")
    return zone_ops.zones_right_join(fares, views.zones(spark, sf), "pu_locid")


def join_full_indicator(spark, sf):
    raw = views.trips_raw(spark, sf)
    last = bases.base_last_seen(views.feed(raw, "fhv"), "month", views.LAST_SEEN)
    return bases.base_breakdown(last, bases.base_license_pairs(views.feed(raw, "fhvhv")))


def join_thresholds(spark, sf):
    buckets = money.fare_buckets(_priced(spark, sf))
    limits = quantiles.exact_quantiles(buckets, ["label", "fare"], "fee_tip", [0.95])
    limits = limits.select("label", "fare", F.col("quantiles")[0].alias("tip_max"))
    kept = zone_ops.below_threshold(buckets, limits, ["label", "fare"], "fee_tip", "tip_max")
    return kept.groupBy("label", "fare").agg(F.count(F.lit(1)).alias("n"), F.max("fee_tip").alias("max_tip"))


def join_zone_lookup(spark, sf):
    named = zone_ops.with_boroughs(views.event_trips(spark, sf), views.zones(spark, sf))
    return named.select("event_id", "pu_locid", "do_locid", "pu_borough", "do_borough")


def join_semi_top_zones(spark, sf):
    arcs = volume.volume_by_arc(views.trips(spark, sf))
    top = volume.top_zones(arcs).select("locid")
    return zone_ops.keep_ids(zone_ops.keep_ids(arcs, top, "pu_locid"), top, "do_locid")


# Zones that a report names, in its order; the last one is unknown.
NAMED = (132, 138, 161, 7, 263, 999)


def resolve_ids(spark, sf):
    return zone_ops.resolve_ids(spark, NAMED, views.zones(spark, sf))


# --- statistics --------------------------------------------------------------------------

STATS = ["mean", "std", "min", "max", "frac_null", "q25", "q50", "q75", "iqr"]
MOMENTS, QUARTILES = ["mean", "std"], ["q25", "q50", "q75", "iqr"]


def _colstats(spark, sf) -> DataFrame:
    return colstats.colstats(clean.with_trip_time(views.trips(spark, sf)))


def colstats_query(spark, sf):
    return rounded(single(_colstats(spark, sf), *MOMENTS), *QUARTILES, places=9)


def colstats_trip_time(spark, sf):
    """Intervals added to a fixed day, so that both engines show the same type."""
    day = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    rows = colstats.as_intervals(rounded(_colstats(spark, sf), *STATS, places=3))
    return rows.select("dataset", *[(day + F.col(c)).alias(c) for c in STATS if c != "frac_null"])


def agg_quantile(spark, sf):
    """Sketch quantiles and whether their rank is off by no more than promised."""
    long = colstats.melt(clean.with_trip_time(views.trips(spark, sf)), "dataset", present=colstats.PRESENT)
    keys = ["dataset", "col"]
    found = long.groupBy(*keys).agg(quantiles.approx_quantile(F.col("value"), 0.95, 1000).alias("estimate"))
    error = quantiles.rank_error(long, keys, "value", found, 0.95, "estimate")
    return error.select(*keys, "n", (F.col("rank_error") <= 0.001 + 1 / F.col("n")).alias("within_bound"))


def exact_quantile(spark, sf):
    """The quantile itself, interpolated between the two values it falls between."""
    long = colstats.melt(clean.with_trip_time(views.trips(spark, sf)), "dataset", present=colstats.PRESENT)
    found = quantiles.exact_quantiles(long, ["dataset", "col"], "value", [0.95])
    return rounded(found.select("dataset", "col", F.col("quantiles")[0].alias("q95")), "q95", places=9)


def agg_quantile_estimates(spark, sf):
    """The estimates themselves, with how far their ranks are off; approximate, so there is no SQL to equal them."""
    long = colstats.melt(clean.with_trip_time(views.trips(spark, sf)), "dataset", present=colstats.PRESENT)
    keys = ["dataset", "col"]
    found = checkpointed(long.groupBy(*keys).agg(quantiles.approx_quantile(F.col("value"), 0.95, 1000).alias("estimate")))
    return found.join(quantiles.rank_error(long, keys, "value", found, 0.95, "estimate"), keys)


def quantile_sketch_table(spark, sf):
    """Medians from a table of monthly sketches that is kept up to date: a second run adds what is new alone."""
    timed = clean.with_trip_time(views.trips(spark, sf)).filter(F.col("trip_time").isNotNull()).withColumn(
        "month", F.trunc("pu_dt", "month"))
    table = quantiles.SketchTable(scratch_path(spark, "sketches"), ["dataset"], "month", "trip_time")
    table.update(timed.filter(F.col("month") < views.SPLIT))
    table.update(timed)
    found = checkpointed(table.merged(spark, ["dataset"]).select("dataset", quantiles.sketch_quantile("sketch", 0.5).alias("estimate")))
    return found.join(quantiles.rank_error(timed, ["dataset"], "trip_time", found, 0.5, "estimate"), "dataset")


def quantile_sketches(spark, sf):
    """Stored monthly sketches merged per feed, and whether the median's rank is within two percent."""
    timed = clean.with_trip_time(views.trips(spark, sf)).withColumn("month", F.trunc("pu_dt", "month"))
    stored = quantiles.sketches(timed.filter(F.col("trip_time").isNotNull()), ["dataset", "month"], "trip_time")
    merged = quantiles.merge_sketches(stored, ["dataset"])
    found = merged.select("dataset", quantiles.sketch_quantile("sketch", 0.5).alias("estimate"))
    error = quantiles.rank_error(timed, ["dataset"], "trip_time", found, 0.5, "estimate")
    return error.select("dataset", "n", (F.col("rank_error") <= 0.02).alias("within_bound"))


# --- volume ------------------------------------------------------------------------------


def volume_month_feed(spark, sf):
    return volume.rides_by_period(views.trips(spark, sf), "month", "dataset")


def volume_month_label(spark, sf):
    return volume.rides_by_period(_labelled(spark, sf), "month", "label")


def _hourly(spark, sf) -> DataFrame:
    return volume.rides_by_period(_labelled(spark, sf), "hour", "label")


def volume_hour_label(spark, sf):
    return _hourly(spark, sf)


def volume_day_profile(spark, sf):
    return rounded(volume.day_profile(_hourly(spark, sf)), "volume", places=9)


def volume_week_profile(spark, sf):
    return rounded(volume.week_profile(_hourly(spark, sf)), "volume", places=9)


def volume_day_profile_split(spark, sf):
    sided = volume.with_side(_hourly(spark, sf), views.SPLIT)
    return rounded(volume.day_profile(sided, side=["side"]), "volume", places=9)


def volume_week_profile_split(spark, sf):
    sided = volume.with_side(_hourly(spark, sf), views.SPLIT)
    return rounded(volume.week_profile(sided, side=["side"]), "volume", places=9)


def volume_zone(spark, sf):
    return volume.volume_by_zone(_labelled(spark, sf))


def volume_zone_scale(spark, sf):
    return rounded(volume.log_scale(volume.volume_by_zone(_labelled(spark, sf))), "log_min", "log_max")


def volume_arc(spark, sf):
    return volume.volume_by_arc(views.trips(spark, sf))


def top_zones(spark, sf):
    return volume.top_zones(volume.volume_by_arc(views.trips(spark, sf)))


def top_zone_names(spark, sf):
    return zone_ops.join_zone_names(top_zones(spark, sf), views.zones(spark, sf)).select("rank", "locid", "zone", "borough")


def _matrix(spark, sf) -> DataFrame:
    arcs = volume.volume_by_arc(views.trips(spark, sf))
    return volume.arc_matrix(arcs, volume.top_zones(arcs))


def arc_matrix(spark, sf):
    return rounded(_matrix(spark, sf), "log_n")


def arc_matrix_wide(spark, sf):
    return rounded(volume.arc_matrix_wide(_matrix(spark, sf)), *[f"to_{i}" for i in range(1, 11)])


def pivot_volume_month(spark, sf):
    monthly = volume.rides_by_period(views.trips(spark, sf), "month", "dataset")
    return volume.pivot_volume(monthly, "month", "dataset", feeds.FEEDS)


def volume_share_month(spark, sf):
    monthly = volume.rides_by_period(_labelled(spark, sf), "month", "label")
    return rounded(volume.volume_share(monthly, "month", "label", volume.LABELS), "share", places=9)


def boroughs_present(spark, sf):
    return zone_ops.boroughs_present(views.trips(spark, sf), views.zones(spark, sf))


# --- money -------------------------------------------------------------------------------


def fare_zone(spark, sf):
    fares = money.fare_by_zone(views.feed(views.trips(spark, sf), "yellow", "green", "fhvhv"))
    return single(fares, "fare_mean")


def payment_types(spark, sf):
    return money.payment_types(views.feed(views.trips(spark, sf), "yellow", "green"), "dataset")


def trip_time_bins(spark, sf):
    return volume.with_label_name(money.trip_time_bins(_labelled(spark, sf)))


def distance_fare_curve(spark, sf):
    curve = money.distance_fare_curve(views.feed(views.trips(spark, sf), "yellow", "green", "fhvhv"))
    return single(curve, "fare", "distance")


def fare_tip_curve(spark, sf):
    return single(money.fare_tip_curve(_priced(spark, sf)), "tip")


def fare_tip_display(spark, sf):
    return money.displayed_points(fare_tip_curve(spark, sf))


# --- operator mapping --------------------------------------------------------------------


def _raw_feed_rows(name: str) -> Query:
    return lambda spark, sf: views.feed(views.trips_raw(spark, sf), name)


def license_counts(spark, sf):
    return bases.license_counts(_raw_feed_rows("fhvhv")(spark, sf))


def base_last_seen(spark, sf):
    return bases.base_last_seen(_raw_feed_rows("fhv")(spark, sf), "month", views.LAST_SEEN)


def base_license_pairs(spark, sf):
    return bases.base_license_pairs(_raw_feed_rows("fhvhv")(spark, sf))


def base_multi_license(spark, sf):
    return bases.base_multi_license(base_license_pairs(spark, sf))


def operator_breakdown(spark, sf):
    return bases.base_sets(join_full_indicator(spark, sf), BIG)


# --- events and streams ------------------------------------------------------------------


def trip_events(spark, sf):
    """Events built, written as JSON messages and decoded again."""
    trips = views.event_trips(spark, sf).drop("duration_minutes")
    encoded = events.encode_events(events.build_events(trips, views.zones(spark, sf)))
    decoded = events.decode_events(encoded)
    return rounded(decoded, "duration_minutes").withColumn("event_ms", epoch_millis(F.col("pu_dt")))


def trip_event_keys(spark, sf):
    encoded = events.encode_events(views.trip_events(spark, sf))
    return encoded.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_ms").alias("first_ms"), F.max("event_ms").alias("last_ms")
    )


def _rolling_batch(seconds: int) -> Query:
    def query(spark, sf):
        rows = views.pickup_events(spark, sf)
        stats = rolling.trailing_stats(rows, "pu_borough", "pu_dt", seconds, keep=["event_id"])
        return _rolled(stats.drop("pu_dt"))

    return query


def rolling_stats_latest(spark, sf):
    rows = views.pickup_events(spark, sf)
    return _rolled(rolling.latest_stats(rows, "pu_borough", "pu_dt", SIX_HOURS))


def _event_stream(spark, sf, start, slices: int = SLICES, closed_after: str | None = None, timed: bool = False) -> None:
    """Replay the events as JSON messages in time order, a micro-batch per slice.

    With ``closed_after`` one event of no borough of the table follows that long after the last one.
    """
    rows = views.trip_events(spark, sf)
    parts = time_slices(rows, "pu_dt", slices)
    if closed_after:
        later = F.col("pu_dt") + F.expr(f"INTERVAL {closed_after}")
        parts.append(rows.orderBy(F.desc("pu_dt")).limit(1).withColumns(
            {"pu_dt": later, "pu_borough": F.lit("END OF REPLAY"), "fare_usd": F.lit(0.0)}))
    replay(spark, [events.encode_events(p) for p in parts], start, timed=timed)


def producer_messages(spark, sf):
    """Both replayed feeds of one year through the producing job, into a folder per topic and back."""
    out = scratch_path(spark, "topics")
    raw = {name: views.raw_feed(spark, sf, name) for name in events.EVENT_SOURCES}
    produce(raw, views.zones(spark, sf), 1997, lambda messages, topic: folder_sink.publish(messages, out, topic), parts=8)
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return spark.read.parquet(out).groupBy("topic", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_ms").alias("first_ms"), F.max("event_ms").alias("last_ms"),
        F.count(field("pu_borough")).alias("boroughs"), F.max(field("fare_usd").cast("float")).cast("double").alias("most"))


def decode_messages(spark, sf):
    """Events whose fares come as numbers, as text, as bad text, as NaN, or in broken JSON."""
    rows = views.trip_events(spark, sf)
    fare = r'"fare_usd":([^,}]+)'
    value = F.col("value")
    forms = [
        value, F.regexp_replace(value, fare, '"fare_usd":"$1"'), F.regexp_replace(value, fare, '"fare_usd":"n/a"'),
        F.regexp_replace(value, fare, '"fare_usd":"NaN"'), F.regexp_replace(value, r"^\{", ""), F.regexp_replace(value, r"\}$", ""),
    ]
    encoded = [events.encode_events(rows.filter(F.col("event_id") % len(forms) == i)).select(form.alias("value"))
               for i, form in enumerate(forms)]
    return events.decode_events(reduce(DataFrame.unionAll, encoded)).groupBy("pu_borough").agg(
        F.count(F.lit(1)).alias("n"), F.count("fare_usd").alias("fares"), F.max("fare_usd").alias("most"),
        F.min("pu_dt").alias("first"))


def _rolling_report(spark, sf) -> RollingReport:
    report = RollingReport(scratch_path(spark, "rolling"), SIX_HOURS)
    _event_stream(spark, sf, lambda s, progress: report.writer(events.decode_events(s), progress))
    return report


def rolling_stats_borough(spark, sf):
    report = _rolling_report(spark, sf)
    return _rolled(report.boroughs(spark, report.last_batch(spark)))


def rolling_stats_top_zones(spark, sf):
    report = _rolling_report(spark, sf)
    return _rolled(report.top_zones(spark, report.last_batch(spark)))


def _broken(messages: DataFrame) -> DataFrame:
    """The messages, of which one in seven by event time has lost its first character."""
    return messages.withColumn("value", F.when(F.col("event_ms") % 7 == 0, F.expr("substring(value, 2)")).otherwise(F.col("value")))


def rolling_report(spark, sf):
    """Reports of a job with a processing-time trigger, over messages of which some are broken."""
    state, table = RollingReport(scratch_path(spark, "rolling"), SIX_HOURS), ReportTable(scratch_path(spark, "reports"))

    def start(stream, progress):
        return report_job(_broken(stream), progress, state.update, lambda s, n: rolling_rows(state, s, n), table, "1 second")

    _event_stream(spark, sf, start, timed=True)
    value = lambda name: F.col("values")[name]
    rows = table.read(spark).select(
        "batch", "scope", "key", "rank", "good", "bad", value("seen").cast("long").alias("seen"), value("n").cast("long").alias("n"),
        *[value(f"{v}_{m}").alias(f"{v}_{m}") for v in rolling.ATTRIBUTES for m in ("mean", "std")])
    return _rolled(rows)


def cluster_report(spark, sf):
    """Reports of macro clusters; they depend on the order of events, so there is no SQL to equal them."""
    state, table = ClusterTable(scratch_path(spark, "micro"), tau=TAU), ReportTable(scratch_path(spark, "reports"))

    def start(stream, progress):
        return cluster_job(stream, progress, state, views.BOROUGHS, table, trigger="1 second")

    _event_stream(spark, sf, start, timed=True)
    return table.read(spark).drop("reported_at").withColumn("values", F.to_json(F.col("values")))


def rolling_windows(spark, sf):
    """Sliding windows of all events; a last event a day later moves the watermark past them."""
    out = scratch_path(spark, "windows")

    def start(stream, progress):
        windows = sliding_stats(events.decode_events(stream), "pu_borough", window="6 hours", slide="1 hour",
                                watermark="1 hour")
        return windows.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)

    _event_stream(spark, sf, start, closed_after="'1' DAY")
    return _rolled(spark.read.parquet(out))


def stream_features(spark, sf):
    rows = decay.with_features(views.pickup_events(spark, sf), boroughs=views.BOROUGHS)
    size = 8 + len(views.BOROUGHS)
    return rows.select("event_id", *[F.round(F.col("features")[i], 9).alias(f"f{i}") for i in range(size)])


def decayed_weight(spark, sf):
    rows = views.pickup_events(spark, sf)
    weights = decay.decayed_weight(rows, ["pu_borough"], decay.latest_ms(rows))
    return single(weights, "weight")


# Messages that the bounded job takes of all that are replayed.
BOUND = 70


def bounded_replay(spark, sf):
    """A job that takes a tenth of its messages' number at the smallest scale, then no more, over all micro-batches."""
    intake = BoundedIntake(scratch_path(spark, "bounded"), BOUND)
    _event_stream(spark, sf, intake.writer, slices=4)
    return intake.messages(spark, "key string, value string, event_ms long").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_ms").alias("first_ms"), F.max("event_ms").alias("last_ms"),
        F.sum("event_ms").alias("sum_ms"))


def _micro(spark, sf, tau: float = TAU, spread: float = 1.0) -> DataFrame:
    """Micro-clusters of the replayed events; ``spread`` scales the borough part of the features."""
    table = ClusterTable(scratch_path(spark, "micro"), tau=tau)
    ones = F.transform(F.slice("features", 9, len(views.BOROUGHS)), lambda v: v * spread)

    def start(stream, progress):
        featured = decay.with_features(events.decode_events(stream), boroughs=views.BOROUGHS)
        if spread != 1.0:
            featured = featured.withColumn("features", F.concat(F.slice("features", 5, 4), ones))
        return table.writer(featured, progress)

    _event_stream(spark, sf, start)
    return table.clusters(spark)


def micro_clusters(spark, sf):
    return _micro(spark, sf).select("cluster", "clock_ms", "weight", "dropped", "radius", "centroid", "ls", "ss")


def micro_cluster_weight(spark, sf):
    return _micro(spark, sf).agg(
        F.round(F.sum("weight") + F.max("dropped"), 2).alias("weight"), F.max("clock_ms").alias("clock_ms"))


# Amounts differ by less than this, boroughs by more once their part is spread.
APART, SPREAD = 5.0, 20.0


def _centers(df: DataFrame, center: str) -> DataFrame:
    borough = [F.when(F.col(center)[4 + i] > SPREAD / 2, name) for i, name in enumerate(views.BOROUGHS)]
    names = ("distance", "fare", "tip", "duration")
    return df.select(F.coalesce(*borough).alias("borough"), F.round("weight", 6).alias("weight"),
                     *[F.round(F.col(center)[i], 6).alias(name) for i, name in enumerate(names)])


def micro_centers(spark, sf):
    """Clusters of boroughs that lie far apart: each is its borough, with the faded means of the amounts."""
    return _centers(_micro(spark, sf, APART, SPREAD), "centroid")


def macro_centers(spark, sf):
    """As many macro clusters as there are micro-clusters far apart: the same centers."""
    return _centers(clusters.macro_clusters(_micro(spark, sf, APART, SPREAD)), "center")


def macro_clusters(spark, sf):
    return clusters.macro_clusters(_micro(spark, sf))


def summary_messages(spark, sf):
    """The summary of clusters far apart, published under its report's time and read again."""
    out, micro = scratch_path(spark, "summaries"), checkpointed(_micro(spark, sf, APART, SPREAD))
    clock = micro.agg(F.max("clock_ms")).first()[0] or 0
    folder_sink.publish(clusters.summary_messages(clusters.macro_clusters(micro), clock), out, "summary")
    parsed = F.from_json("value", "k int, clusters array<struct<id:int, weight:double, center:array<double>>>")
    weight = F.aggregate("v.clusters", F.lit(0.0), lambda s, c: s + c.weight)
    return spark.read.parquet(out).select("key", parsed.alias("v")).select("key", "v.k", F.round(weight, 4).alias("weight"))


def macro_summary(spark, sf):
    return clusters.macro_summary(clusters.macro_clusters(_micro(spark, sf)))


def queries() -> dict[str, Query]:
    """Every registered query by key."""
    return {
        "src_month_files": src_month_files,
        "src_month_rows": src_month_rows,
        "src_feed_scan": src_feed_scan,
        "src_partition_read": src_partition_read,
        "src_columns_union": src_columns_union,
        "sink_repartition": sink_repartition,
        "sink_format_matrix": sink_format_matrix,
        "format_report": format_report,
        "repack_feed": repack_feed,
        "feed_sql_view": feed_sql_view,
        "zone_load": zone_load,
        "src_csv": src_csv,
        "schema_profile": schema_profile,
        "schema_evolution": schema_evolution,
        "schema_final": schema_final,
        "conform_schema": conform_schema,
        "feed_bytes": feed_bytes,
        "file_size_histogram": file_size_histogram,
        "universal_trips": universal_trips,
        "clean_zones": clean_zones,
        "clean_dropoff": clean_dropoff,
        "clean_amounts": clean_amounts,
        "clean_base": clean_base,
        "trip_time": trip_time,
        "label_fhv": label_fhv,
        "label_fhvhv": label_fhvhv,
        "flag_to_bool": flag_to_bool,
        "location_names": location_names,
        "constant_label": constant_label,
        "pick_columns": pick_columns,
        **{f"anomaly_{name}": _anomalies(name) for name in feeds.FEEDS},
        "anomaly_fractions": anomaly_fractions,
        "anomaly_by_zone": anomaly_by_zone,
        "anomaly_zone_rate": anomaly_zone_rate,
        "anomaly_zone_top5": anomaly_zone_top5,
        "join_zone_names": join_zone_names,
        "join_zone_names_twice": join_zone_names_twice,
        "join_zones_right": join_zones_right,
        "join_full_indicator": join_full_indicator,
        "join_thresholds": join_thresholds,
        "join_zone_lookup": join_zone_lookup,
        "join_semi_top_zones": join_semi_top_zones,
        "resolve_ids": resolve_ids,
        "colstats": colstats_query,
        "colstats_trip_time": colstats_trip_time,
        "agg_quantile": agg_quantile,
        "agg_quantile_estimates": agg_quantile_estimates,
        "quantile_sketch_table": quantile_sketch_table,
        "exact_quantile": exact_quantile,
        "quantile_sketches": quantile_sketches,
        "volume_month_feed": volume_month_feed,
        "volume_month_label": volume_month_label,
        "volume_hour_label": volume_hour_label,
        "volume_day_profile": volume_day_profile,
        "volume_week_profile": volume_week_profile,
        "volume_day_profile_split": volume_day_profile_split,
        "volume_week_profile_split": volume_week_profile_split,
        "volume_zone": volume_zone,
        "volume_zone_scale": volume_zone_scale,
        "volume_arc": volume_arc,
        "top_zones": top_zones,
        "top_zone_names": top_zone_names,
        "arc_matrix": arc_matrix,
        "arc_matrix_wide": arc_matrix_wide,
        "pivot_volume_month": pivot_volume_month,
        "volume_share_month": volume_share_month,
        "boroughs_present": boroughs_present,
        "fare_zone": fare_zone,
        "payment_types": payment_types,
        "trip_time_bins": trip_time_bins,
        "distance_fare_curve": distance_fare_curve,
        "fare_tip_curve": fare_tip_curve,
        "fare_tip_display": fare_tip_display,
        "license_counts": license_counts,
        "base_last_seen": base_last_seen,
        "base_license_pairs": base_license_pairs,
        "base_multi_license": base_multi_license,
        "operator_breakdown": operator_breakdown,
        "trip_events": trip_events,
        "trip_event_keys": trip_event_keys,
        "producer_messages": producer_messages,
        "decode_messages": decode_messages,
        "rolling_stats_batch": _rolling_batch(15 * 60),
        "rolling_stats_batch_6h": _rolling_batch(SIX_HOURS),
        "rolling_stats_latest": rolling_stats_latest,
        "rolling_stats_borough": rolling_stats_borough,
        "rolling_stats_top_zones": rolling_stats_top_zones,
        "rolling_windows": rolling_windows,
        "rolling_report": rolling_report,
        "cluster_report": cluster_report,
        "bounded_replay": bounded_replay,
        "stream_features": stream_features,
        "decayed_weight": decayed_weight,
        "micro_clusters": micro_clusters,
        "micro_cluster_weight": micro_cluster_weight,
        "micro_centers": micro_centers,
        "macro_clusters": macro_clusters,
        "macro_centers": macro_centers,
        "summary_messages": summary_messages,
        "macro_summary": macro_summary,
    }

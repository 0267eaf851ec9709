"""DuckDB SQL twins of the registered queries, over the same given tables."""

from __future__ import annotations

FEEDS = ("yellow", "green", "fhv", "fhvhv")

TRIPS_RAW = """
SELECT
  CASE WHEN l_returnflag='A' THEN 'yellow' WHEN l_returnflag='N' THEN 'green'
       WHEN l_linestatus='F' THEN 'fhv' ELSE 'fhvhv' END AS dataset,
  CAST(YEAR(l_shipdate) - CASE WHEN l_orderkey % 211 = 0 THEN 1 ELSE 0 END AS INT) AS src_year,
  CAST(l_shipdate + INTERVAL '1' SECOND * ((l_partkey*3607 + l_suppkey*61 + l_orderkey) % 86400) AS TIMESTAMP) AS pu_dt,
  CAST(l_shipdate + INTERVAL '1' SECOND * ((l_partkey*3607 + l_suppkey*61 + l_orderkey) % 86400
     + CASE WHEN l_orderkey % 499 = 0 THEN 3456000 WHEN l_orderkey % 97 = 0 THEN 0
            ELSE (l_orderkey*7 + l_linenumber*131) % 7500 - 300 END) AS TIMESTAMP) AS do_dt,
  CAST(l_partkey % 270 AS INT) AS pu_locid,
  CAST((l_partkey*31 + l_suppkey) % 270 AS INT) AS do_locid,
  l_linenumber - 1 AS passengers,
  CASE WHEN l_returnflag='R' AND l_linestatus='F' THEN NULL ELSE (l_quantity-1)*0.5 END AS distance,
  CASE WHEN l_returnflag='R' AND l_linestatus='F' THEN NULL ELSE l_extendedprice/100 - 20 END AS fee_fare,
  CASE WHEN l_returnflag='R' AND l_linestatus='F' THEN NULL ELSE l_extendedprice*l_discount/100 END AS fee_tip,
  CASE WHEN l_returnflag='R' THEN NULL ELSE l_extendedprice*(1+l_discount+l_tax)/100 - 20 END AS fee_total,
  CASE WHEN l_returnflag='R' OR l_orderkey % 11 = 0 THEN NULL ELSE CAST(l_orderkey % 7 AS INT) END AS payment_type,
  CASE WHEN l_returnflag<>'R' OR l_suppkey % 23 = 0 THEN NULL WHEN l_suppkey % 19 = 0 THEN 'null'
       ELSE CONCAT('b', CAST(l_suppkey % 62 AS VARCHAR)) END AS dbasenum,
  CASE WHEN l_returnflag='R' AND l_linestatus='O' THEN CONCAT('HV000', CAST(2 + l_suppkey % 4 AS VARCHAR)) END AS licensenum
FROM lineitem
"""

ZONES = """
SELECT CAST(z.id AS INT) AS locid, CONCAT('Zone ', CAST(z.id AS VARCHAR)) AS zone, r_name AS borough
FROM (SELECT unnest(range(1,264)) AS id) z JOIN nation ON z.id % 25 = n_nationkey JOIN region ON n_regionkey=r_regionkey
"""

CLEAN = {
    "do_dt": "CASE WHEN do_dt <= pu_dt OR pu_dt + INTERVAL '30' DAY < do_dt THEN NULL ELSE do_dt END",
    "pu_locid": "CASE WHEN pu_locid BETWEEN 1 AND 263 THEN pu_locid END",
    "do_locid": "CASE WHEN do_locid BETWEEN 1 AND 263 THEN do_locid END",
    "passengers": "CASE WHEN passengers > 0 THEN passengers END",
    "distance": "CASE WHEN distance > 0 THEN distance END",
    "fee_fare": "CASE WHEN fee_fare >= 0 THEN fee_fare END",
    "fee_tip": "CASE WHEN fee_tip >= 0 THEN fee_tip END",
    "fee_total": "CASE WHEN fee_total >= 0 THEN fee_total END",
    "dbasenum": "NULLIF(UPPER(dbasenum),'NULL')",
}

TRIPS = (
    "SELECT dataset, pu_dt, payment_type, licensenum, "
    + ", ".join(f"{expr} AS {name}" for name, expr in CLEAN.items())
    + " FROM trips_raw WHERE pu_dt >= TIMESTAMP '1995-01-01 00:00:00' AND pu_dt < TIMESTAMP '2002-01-01 00:00:00'"
)

LAST_SEEN = """
SELECT dbn, ls FROM (SELECT UPPER(dbasenum) AS dbn, MAX(pu_dt) AS ls FROM trips_raw
  WHERE dataset='fhv' AND dbasenum IS NOT NULL GROUP BY 1) WHERE date_trunc('month', ls) = TIMESTAMP '2001-10-01'
"""
PAIRS = """
SELECT DISTINCT UPPER(dbasenum) AS dbn, licensenum AS ln FROM trips_raw WHERE dataset='fhvhv' AND UPPER(dbasenum) <> 'NULL'
"""
BREAKDOWN = """
SELECT COALESCE(a.dbn, b.dbn) AS dbn, a.ls, b.ln,
  CASE WHEN b.dbn IS NULL THEN 'left_only' WHEN a.dbn IS NULL THEN 'right_only' ELSE 'both' END AS origin
FROM last_seen a FULL JOIN pairs b ON a.dbn = b.dbn
"""
LABELLED = """
SELECT *, CASE
  WHEN dataset='fhv' THEN CASE WHEN dbasenum IS NULL THEN NULL
     WHEN dbasenum IN (SELECT dbn FROM breakdown WHERE origin='both' AND ln IN ('HV0003','HV0005')) THEN 'fhv_big' ELSE 'fhv_small' END
  WHEN dataset='fhvhv' THEN CASE WHEN licensenum IS NULL THEN NULL
     WHEN licensenum IN ('HV0003','HV0005') THEN 'fhv_big' ELSE 'fhv_small' END
  ELSE dataset END AS label FROM trips
"""
HOURLY = """
SELECT date_trunc('hour', pu_dt) AS hour, label, COUNT(*) AS volume FROM labelled WHERE label IS NOT NULL GROUP BY 1, 2
"""
ARCS = """
SELECT pu_locid, do_locid, COUNT(*) AS n FROM trips WHERE pu_locid IS NOT NULL AND do_locid IS NOT NULL GROUP BY 1, 2
"""
TOP = """
SELECT locid, n, CAST(row_number() OVER (ORDER BY n DESC, locid) AS INT) AS rank FROM (
  SELECT locid, CAST(SUM(n) AS BIGINT) AS n FROM (
    SELECT pu_locid AS locid, n FROM arcs UNION ALL SELECT do_locid, n FROM arcs) GROUP BY 1)
QUALIFY rank <= 10
"""
FLAGS = {
    "year_out_of_range": "YEAR({pu}) <> src_year",
    "time_zero": "{pu} = {do}",
    "time_negative": "{pu} > {do}",
    "time_very_high": "{do} - {pu} > INTERVAL '14' DAY",
    "location_invalid": "NOT ((pu_locid IS NULL OR pu_locid BETWEEN 1 AND 263) AND (do_locid IS NULL OR do_locid BETWEEN 1 AND 263))",
    "distance_zero": "distance = 0",
    "distance_negative": "distance < 0",
    "fare_very_high": "{fare} > 1000",
    "fare_negative": "{fare} < 0",
}
FLAG_TEXT = {
    "year_out_of_range": "Year out of range",
    "time_zero": "Pickup == dropoff",
    "time_negative": "Pickup > dropoff",
    "time_very_high": "Dropoff - pickup > 14 days",
    "location_invalid": "Invalid taxi zone",
    "distance_zero": "Trip distance == 0",
    "distance_negative": "Trip distance < 0",
    "fare_very_high": "Fare > 1000",
    "fare_negative": "Fare < 0",
}


def _flag(name: str, fare: str = "CAST(fee_fare AS FLOAT)") -> str:
    return FLAGS[name].format(pu="pu_dt", do="do_dt", fare=fare)


BY_ZONE = (
    "SELECT label, locid, COUNT(*) AS rows, COUNT(*) FILTER (WHERE is_err) AS errors FROM ("
    + " UNION ALL ".join(
        f"SELECT dataset AS label, {end} AS locid, COALESCE("
        + " OR ".join(_flag(name, "fee_fare") for name in FLAGS)
        + ", FALSE) AS is_err FROM trips_raw"
        for end in ("pu_locid", "do_locid")
    )
    + ") WHERE locid BETWEEN 1 AND 263 GROUP BY 1, 2"
)

TRIP_EVENTS = """
SELECT e.*, p.borough AS pu_borough, d.borough AS do_borough FROM (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'yellow' ELSE 'fhvhv' END AS dataset,
    ts AS pu_dt, ts + INTERVAL '1' SECOND * ((event_id * 7) % 5400) AS do_dt,
    CAST(user_id % 263 + 1 AS INT) AS pu_locid, CAST((user_id * 31 + event_id) % 263 + 1 AS INT) AS do_locid,
    CASE WHEN event_id % 13 <> 0 THEN CAST(json_extract_string(props,'$.k') AS DOUBLE) / 10 END AS distance_miles,
    value AS fare_usd, CASE WHEN event_type = 'purchase' THEN value * CAST(0.2 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tip_usd,
    CAST((event_id * 7) % 5400 AS DOUBLE) / 60 AS duration_minutes
  FROM events) e
LEFT JOIN zones p ON p.locid = e.pu_locid LEFT JOIN zones d ON d.locid = e.do_locid
"""

PRESENT = {
    "yellow": ["passengers", "distance", "trip_time", "fee_fare", "fee_tip", "fee_total"],
    "green": ["passengers", "distance", "trip_time", "fee_fare", "fee_tip", "fee_total"],
    "fhv": ["trip_time"],
    "fhvhv": ["distance", "trip_time", "fee_fare", "fee_tip"],
}
LONG = " UNION ALL ".join(
    f"SELECT dataset, '{col}' AS col, CAST("
    + ("date_diff('microsecond', pu_dt, do_dt) / 1e6" if col == "trip_time" else col)
    + f" AS DOUBLE) AS value FROM trips WHERE dataset = '{feed}'"
    for feed, cols in PRESENT.items()
    for col in cols
)
STATS = """
SELECT dataset, col, AVG(value) AS mean, STDDEV_SAMP(value) AS std, MIN(value) AS min, MAX(value) AS max,
  1 - COUNT(value) / COUNT(*) AS frac_null, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50,
  quantile_cont(value, 0.75) AS q75, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr
FROM long GROUP BY 1, 2
"""
BUCKETS = """
SELECT CASE WHEN dataset='fhvhv' THEN CASE WHEN licensenum IN ('HV0003','HV0005') THEN 'fhv_big'
    WHEN licensenum IS NOT NULL THEN 'fhv_small' END ELSE dataset END AS label,
  CAST(FLOOR(fee_fare / 10) * 10 + 5 AS INT) AS fare, fee_tip
FROM trips WHERE dataset <> 'fhv' AND fee_fare < 1000 AND fee_fare IS NOT NULL AND fee_tip IS NOT NULL
"""
LIMITS = "SELECT label, fare, quantile_cont(fee_tip, 0.95) AS tip_max FROM buckets WHERE label IS NOT NULL GROUP BY 1, 2"

# Which years of the drifting history have which column: (field, type, null rule, years).
HISTORY_FIELDS = [
    ("tpep_pickup_datetime", "timestamp[us]", "FALSE", "1995, 1996, 1997, 1998, 1999, 2000, 2001"),
    ("PULocationID", "int64", "FALSE", "1995, 1996, 1997, 1998, 1999, 2000, 2001"),
    ("trip_distance", "double", "FALSE", "1995, 1996, 1997, 1998, 1999, 2000, 2001"),
    ("fare_amount", "double", "FALSE", "1995, 1996, 1997, 1998, 1999, 2000, 2001"),
    ("VendorID", "int64", "FALSE", "1995, 1996, 1997, 1998, 1999"),
    ("VendorID", "int32", "FALSE", "2000, 2001"),
    ("passenger_count", "int64", "FALSE", "1995, 2000, 2001"),
    ("passenger_count", "double", "FALSE", "1996, 1997, 1998, 1999"),
    ("mta_tax", "double", "FALSE", "1995, 1996, 1997, 2001"),
    ("congestion_surcharge", "double", "l_orderkey % 3 = 0", "1997"),
    ("congestion_surcharge", "double", "FALSE", "1998, 1999, 2000, 2001"),
    ("airport_fee", "double", "l_orderkey % 5 = 0", "1999"),
    ("airport_fee", "double", "FALSE", "2000"),
    ("Airport_fee", "double", "FALSE", "2001"),
]
HISTORY_PROFILE = " UNION ALL ".join(
    "SELECT concat('yellow_tripdata_', strftime(l_shipdate, '%Y-%m'), '.parquet') AS file, "
    f"'{field}' AS field, '{type_}' AS type, bool_or({nulls}) AS has_nulls "
    f"FROM lineitem WHERE YEAR(l_shipdate) IN ({years}) GROUP BY 1"
    for field, type_, nulls, years in HISTORY_FIELDS
)
HISTORY_STATES = """
SELECT *, concat(CASE WHEN nullable THEN '?' ELSE '' END, effective) AS shown,
  lag(concat(CASE WHEN nullable THEN '?' ELSE '' END, effective)) OVER (PARTITION BY field, run ORDER BY i) AS previous,
  lead(i) OVER (PARTITION BY field, run ORDER BY i) IS NULL AS last_of_run
FROM (
  SELECT *, bool_or(has_nulls) OVER (PARTITION BY field, run ORDER BY i) AS nullable, type AS effective
  FROM (SELECT p.*, f.i, f.next_file, f.i - row_number() OVER (PARTITION BY field ORDER BY f.i) AS run
        FROM profile p JOIN (SELECT file, row_number() OVER (ORDER BY file) - 1 AS i, lead(file) OVER (ORDER BY file) AS next_file
                             FROM (SELECT DISTINCT file FROM profile)) f USING (file)))
"""

# Given table -> (column, Arrow type); footers of the given files state these.
GIVEN = {
    "region": "r_regionkey int32, r_name string",
    "nation": "n_nationkey int32, n_name string, n_regionkey int32",
    "customer": "c_custkey int64, c_name string, c_nationkey int32, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey int64, s_name string, s_nationkey int32, s_acctbal double",
    "part": "p_partkey int64, p_name string, p_brand string, p_type string, p_size int32, p_retailprice double",
    "orders": "o_orderkey int64, o_custkey int64, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp[us], o_orderpriority string",
    "lineitem": "l_orderkey int64, l_partkey int64, l_suppkey int64, l_linenumber int32, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp[us]",
    "events": "event_id int64, ts timestamp[us], user_id int64, event_type string, value double, props string",
    "documents": "doc_id int64, text string, lang string, source string, n_chars int64",
    "embeddings": "vec_id int64, embedding list<element:_float>, label int32",
    "pages": "page_id int64, url string, html string",
    "benchmark": "item_id int64, text string",
    "labels": "doc_id int64, quality int32, toxic int32",
    "conversations": "conv_id int64, turn int64, role string, text string",
}
GIVEN_PROFILE = " UNION ALL ".join(
    f"SELECT '{table}.parquet' AS file, '{name}' AS field, '{type_.replace('_', ' ')}' AS type, "
    f"COUNT({name}) < COUNT(*) AS has_nulls FROM {table}"
    for table, columns in GIVEN.items()
    for name, type_ in (part.split() for part in columns.split(", "))
)

CTES = {
    "trips_raw": (TRIPS_RAW, []),
    "zones": (ZONES, []),
    "trips": (TRIPS, ["trips_raw"]),
    "last_seen": (LAST_SEEN, ["trips_raw"]),
    "pairs": (PAIRS, ["trips_raw"]),
    "breakdown": (BREAKDOWN, ["last_seen", "pairs"]),
    "labelled": (LABELLED, ["trips", "breakdown"]),
    "hourly": (HOURLY, ["labelled"]),
    "arcs": (ARCS, ["trips"]),
    "top": (TOP, ["arcs"]),
    "by_zone": (BY_ZONE, ["trips_raw"]),
    "trip_events": (TRIP_EVENTS, ["zones"]),
    "long": (LONG, ["trips"]),
    "stats": (STATS, ["long"]),
    "buckets": (BUCKETS, ["trips"]),
    "limits": (LIMITS, ["buckets"]),
    "profile": (HISTORY_PROFILE, []),
    "states": (HISTORY_STATES, ["profile"]),
}


def _needed(names: list[str]) -> list[str]:
    order: list[str] = []
    for name in names:
        for found in _needed(CTES[name][1]) + [name]:
            if found not in order:
                order.append(found)
    return order


def using(*names: str, query: str) -> str:
    """A query with the named tables, and those they need, in front of it."""
    parts = [f"{name} AS ({CTES[name][0]})" for name in _needed(list(names))]
    return "WITH " + ", ".join(parts) + " " + query


def _anomaly(feed: str) -> str:
    flags = [f for f in FLAGS if feed != "fhv" or f.split("_")[0] in ("year", "time", "location")]
    counts = ", ".join(f"COUNT(*) FILTER (WHERE {_flag(f)}) AS {f}" for f in flags)
    return f"SELECT src_year, COUNT(*) AS rows, {counts} FROM trips_raw WHERE dataset = '{feed}' GROUP BY 1"


def _fractions() -> str:
    parts = []
    for feed in FEEDS:
        flags = [f for f in FLAGS if feed != "fhv" or f.split("_")[0] in ("year", "time", "location")]
        if feed == "fhvhv":
            flags = [f for f in flags if f not in ("year_out_of_range", "distance_negative")]
        parts += [
            f"SELECT '{feed}' AS dataset, src_year AS year, '{FLAG_TEXT[f]}' AS anomaly, "
            f"ROUND(COUNT(*) FILTER (WHERE {_flag(f)}) / COUNT(*), 9) AS fraction "
            f"FROM trips_raw WHERE dataset = '{feed}' GROUP BY src_year"
            for f in flags
        ]
    return using("trips_raw", query=" UNION ALL ".join(parts))


# The trip table's columns per feed: those every feed may have, and those kept from one feed.
UNIVERSAL = {
    "yellow": (
        "pu_dt TIMESTAMP, do_dt TIMESTAMP, pu_locid INT, do_locid INT, passengers INT, distance FLOAT, fee_fare FLOAT, "
        "fee_tip FLOAT, fee_total FLOAT, payment_type INT",
        "x_airport_fee FLOAT, x_ratecodeid INT, x_vendorid INT, x_congestion_surcharge FLOAT, x_extra FLOAT, "
        "x_improvement_surcharge FLOAT, x_mta_tax FLOAT, x_store_and_fwd_flag VARCHAR, x_tolls_amount FLOAT",
    ),
    "green": (
        "pu_dt TIMESTAMP, do_dt TIMESTAMP, pu_locid INT, do_locid INT, passengers INT, distance FLOAT, fee_fare FLOAT, "
        "fee_tip FLOAT, fee_total FLOAT, payment_type INT",
        "x_ratecodeid INT, x_vendorid INT, x_congestion_surcharge FLOAT, x_ehail_fee FLOAT, x_extra FLOAT, "
        "x_improvement_surcharge FLOAT, x_mta_tax FLOAT, x_store_and_fwd_flag VARCHAR, x_tolls_amount FLOAT, x_trip_type INT",
    ),
    "fhv": (
        "pu_dt TIMESTAMP, do_dt TIMESTAMP, pu_locid INT, do_locid INT, dbasenum VARCHAR",
        "x_affiliated_base_number VARCHAR, x_sr_flag BOOLEAN",
    ),
    "fhvhv": (
        "pu_dt TIMESTAMP, do_dt TIMESTAMP, pu_locid INT, do_locid INT, distance FLOAT, fee_fare FLOAT, fee_tip FLOAT, "
        "dbasenum VARCHAR, licensenum VARCHAR",
        "x_access_a_ride_flag VARCHAR, x_airport_fee FLOAT, x_bcf FLOAT, x_congestion_surcharge FLOAT, x_driver_pay FLOAT, "
        "x_on_scene_datetime TIMESTAMP, x_originating_base_num VARCHAR, x_request_datetime TIMESTAMP, x_sales_tax FLOAT, "
        "x_shared_match_flag VARCHAR, x_shared_request_flag VARCHAR, x_tolls FLOAT, x_trip_time INT, x_wav_match_flag VARCHAR, "
        "x_wav_request_flag VARCHAR",
    ),
}
# What the fixture puts into a column of each type that trips do not have.
FILLER = {
    "FLOAT": "distance", "INT": "passengers", "VARCHAR": "CASE WHEN passengers % 2 = 0 THEN 'Y' ELSE 'N' END",
    "TIMESTAMP": "pu_dt", "BOOLEAN": "passengers > 2",
}


def _universal() -> str:
    parts = []
    for feed, (common, extra) in UNIVERSAL.items():
        own, kept = ([tuple(c.split()) for c in text.split(", ")] for text in (common, extra))
        inner = [f"CAST({name} AS {kind}) AS {name}" for name, kind in own]
        inner += [f"CAST({FILLER[kind]} AS {kind}) AS {name}" for name, kind in kept]
        outer = []
        for name, kind in own + kept:
            value = CLEAN.get(name, name)
            outer.append((f"CAST({value} AS DOUBLE)" if kind == "FLOAT" else value) + f" AS {name}")
        parts.append(f"SELECT '{feed}' AS dataset, {', '.join(outer)} FROM (SELECT {', '.join(inner)} "
                     f"FROM trips_raw WHERE dataset = '{feed}')")
    return using("trips_raw", query=" UNION ALL BY NAME ".join(parts))


def _profile_split(key: str, part: str, total: str, side: bool) -> str:
    """Average share by ``key`` over ``part`` periods; ``total`` names the hourly or daily rows."""
    s = "side, " if side else ""
    return (
        f"SELECT {s}{key}, a.label, ROUND(SUM(a.volume / t.v) / MAX(n.n), 9) AS volume FROM {total} a "
        f"JOIN (SELECT {s}{part}, SUM(volume) AS v FROM {total} GROUP BY ALL) t USING ({s}{part}) "
        + (f"JOIN (SELECT side, COUNT(DISTINCT {part}) AS n FROM {total} GROUP BY 1) n USING (side) " if side
           else f"CROSS JOIN (SELECT COUNT(DISTINCT {part}) AS n FROM {total}) n ")
        + "GROUP BY ALL"
    )


_SIDED = "SELECT *, CASE WHEN hour < TIMESTAMP '1998-07-01' THEN 'before' ELSE 'after' END AS side FROM hourly"


def _day_profile(side: bool) -> str:
    return using("hourly", query=(
        f"SELECT * FROM (WITH days AS (SELECT * EXCLUDE (hour), CAST(EXTRACT(hour FROM hour) AS INT) AS hour, "
        f"date_trunc('day', hour) AS day FROM ({_SIDED})) " + _profile_split("a.hour", "day", "days", side) + ")"
    ))


def _week_profile(side: bool) -> str:
    s = "side, " if side else ""
    return using("hourly", query=(
        f"SELECT * FROM (WITH days AS (SELECT {s}label, date_trunc('day', hour) AS day, SUM(volume) AS volume, "
        f"CAST(isodow(date_trunc('day', hour)) - 1 AS INT) AS weekday, "
        f"date_trunc('week', date_trunc('day', hour) - INTERVAL '1' DAY) AS week FROM ({_SIDED}) GROUP BY ALL) "
        + _profile_split("a.weekday", "week", "days", side) + ")"
    ))


def _moments(prefix: str = "") -> str:
    return ", ".join(
        f"CAST(CAST(AVG({prefix}{v}) AS FLOAT) AS DOUBLE) AS {v}_mean, ROUND(STDDEV_POP({prefix}{v}), 8) AS {v}_std"
        for v in ("distance_miles", "fare_usd", "tip_usd")
    )


_FILLED = (
    "SELECT event_id, pu_dt, pu_borough, pu_locid, COALESCE(distance_miles, 0) AS distance_miles, "
    "COALESCE(fare_usd, 0) AS fare_usd, COALESCE(tip_usd, 0) AS tip_usd FROM trip_events "
    "WHERE distance_miles IS NOT NULL OR fare_usd IS NOT NULL OR tip_usd IS NOT NULL"
)


def _rolling(minutes: int) -> str:
    frame = f"(PARTITION BY pu_borough ORDER BY pu_dt RANGE BETWEEN INTERVAL {minutes} MINUTES PRECEDING AND CURRENT ROW)"
    stats = ", ".join(
        f"CAST(CAST(AVG({v}) OVER w AS FLOAT) AS DOUBLE) AS {v}_mean, ROUND(STDDEV_POP({v}) OVER w, 8) AS {v}_std"
        for v in ("distance_miles", "fare_usd", "tip_usd")
    )
    return using("trip_events", query=(
        f"SELECT event_id, pu_borough, COUNT(*) OVER w AS n, {stats} FROM ({_FILLED}) "
        f"WHERE pu_borough IS NOT NULL WINDOW w AS {frame}"
    ))


def _latest(key: str) -> str:
    return (
        f"SELECT {key}, last_ts, COUNT(*) AS n, {_moments()} FROM ({_FILLED}) "
        f"JOIN (SELECT {key}, MAX(pu_dt) AS last_ts FROM ({_FILLED}) GROUP BY 1) USING ({key}) "
        "WHERE pu_dt >= last_ts - INTERVAL '6' HOUR GROUP BY 1, 2"
    )


def _reports() -> str:
    """Both reports of the replayed events; the second also holds what the first one saw."""
    parts = []
    for batch in (0, 1):
        shown = f"SELECT * FROM sliced WHERE slice <= {batch}"
        good = f"SELECT * FROM ({shown}) WHERE ms % 7 <> 0"
        read = [f"(SELECT COUNT(*) FROM sliced WHERE slice = {batch} AND ms % 7 {sign} 0) AS {name}" for sign, name in (("<>", "good"), ("=", "bad"))]
        of = lambda key: _latest(key).replace("FROM trip_events", f"FROM ({good})")
        seen = (f"SELECT pu_locid, COUNT(*) AS seen, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, pu_locid) AS INT) AS rank "
                f"FROM ({good}) WHERE pu_locid IS NOT NULL GROUP BY 1 QUALIFY rank <= 10")
        tail = f"CAST({batch} AS BIGINT) AS batch, " + ", ".join(read)
        parts.append(f"SELECT 'borough' AS scope, pu_borough AS key, CAST(NULL AS INT) AS rank, CAST(NULL AS BIGINT) AS seen, * EXCLUDE (pu_borough, last_ts), {tail} "
                     f"FROM ({of('pu_borough')}) WHERE pu_borough IS NOT NULL")
        parts.append(f"SELECT 'zone' AS scope, CAST(pu_locid AS VARCHAR) AS key, rank, seen, * EXCLUDE (pu_locid, last_ts, rank, seen), {tail} "
                     f"FROM ({seen}) LEFT JOIN ({of('pu_locid')}) USING (pu_locid)")
    return using("trip_events", query="SELECT * FROM (" + " UNION ALL BY NAME ".join(parts) + ")").replace(" SELECT * FROM (SELECT 'borough'", (
        ", spanned AS (SELECT *, epoch_us(pu_dt) AS us, epoch_us(pu_dt) // 1000 AS ms FROM trip_events WHERE pu_dt IS NOT NULL), "
        "sliced AS (SELECT *, (us - (SELECT MIN(us) FROM spanned)) // ((SELECT MAX(us) - MIN(us) + 2 FROM spanned) // 2) AS slice FROM spanned)"
        " SELECT * FROM (SELECT 'borough'"), 1)


def _repacks() -> str:
    parts = []
    for feed, size, start in (("yellow", 2000, "2012-01"), ("green", 2000, "2014-01"), ("fhv", 2000, "2015-01"), ("fhvhv", 1000, "2019-02")):
        parts.append(
            f"SELECT '{feed}' AS dataset, year, CAST(CEIL(n / {size}) AS BIGINT) AS files, CAST(n // {size} AS BIGINT) AS full_files, n AS rows FROM ("
            f"SELECT CAST(YEAR(pu_dt) + 20 AS INT) AS year, COUNT(*) AS n FROM trips_raw WHERE dataset = '{feed}' "
            f"AND pu_dt + INTERVAL '20' YEAR >= TIMESTAMP '{start}-01' GROUP BY 1)")
    return using("trips_raw", query=" UNION ALL ".join(parts))


def _features() -> str:
    hour = "(2 * pi() * ((hour(pu_dt) + minute(pu_dt) / 60) / 24))"
    day = "(2 * pi() * ((isodow(pu_dt) - 1) / 7))"
    columns = [f"sin({hour})", f"cos({hour})", f"sin({day})", f"cos({day})"]
    for name, scale in (("distance_miles", 5), ("fare_usd", 6), ("tip_usd", 5), ("duration_minutes", 6)):
        columns.append(f"CASE WHEN {name} > 0 THEN ln(1 + {name}) ELSE 0 END / {scale}")
    for borough in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"):
        columns.append(f"CASE WHEN pu_borough = '{borough}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END")
    picked = ", ".join(f"ROUND({c}, 9) + 0.0 AS f{i}" for i, c in enumerate(columns))
    return using("trip_events", query=f"SELECT event_id, {picked} FROM trip_events")


def _borough_centers() -> str:
    """Faded weight and weighted means of the scaled amounts, per borough that has not faded away."""
    amounts = {"distance": ("distance_miles", 5), "fare": ("fare_usd", 6), "tip": ("tip_usd", 5), "duration": ("duration_minutes", 6)}
    means = ", ".join(
        f"ROUND(SUM(w * CASE WHEN {c} > 0 THEN ln(1 + {c}) ELSE 0 END / {scale}) / SUM(w), 6) AS {name}"
        for name, (c, scale) in amounts.items())
    known = "CASE WHEN pu_borough IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST') THEN pu_borough END"
    return using("trip_events", query=(
        f"SELECT borough, ROUND(SUM(w), 6) AS weight, {means} FROM (SELECT *, {known} AS borough, "
        "pow(0.5, (MAX(epoch_us(pu_dt) // 1000) OVER () - epoch_us(pu_dt) // 1000) / (360 * 60000.0)) AS w FROM trip_events) "
        "GROUP BY 1 HAVING SUM(w) > 1e-6"))


def oracle_sql() -> dict[str, str]:
    """SQL per registered key, where SQL can express it."""
    fare_tip = (
        "SELECT label, fare, CAST(CAST(AVG(fee_tip) AS FLOAT) AS DOUBLE) AS tip, COUNT(*) AS n FROM buckets "
        "JOIN limits USING (label, fare) WHERE fee_tip < tip_max GROUP BY 1, 2"
    )
    stats = ["mean", "std", "min", "max", "q25", "q50", "q75", "iqr"]
    decayed = "SUM(CASE WHEN now_ms - ms <= 0 THEN 1 ELSE pow(0.5, (now_ms - ms) / (360 * 60000.0)) END)"
    aged = (
        "(SELECT pu_borough, epoch_us(pu_dt) // 1000 AS ms, MAX(epoch_us(pu_dt) // 1000) OVER () AS now_ms FROM trip_events)"
    )
    return {
        "src_month_files": using("trips_raw", query=(
            "SELECT DISTINCT 'yellow_tripdata' AS category, CAST(YEAR(pu_dt) AS INT) AS src_year, "
            "CAST(MONTH(pu_dt) AS INT) AS src_month FROM trips_raw WHERE dataset='yellow' AND pu_dt >= TIMESTAMP '1998-01-01'")),
        "src_month_rows": using("trips_raw", query=(
            "SELECT CAST(YEAR(pu_dt) AS INT) AS src_year, CAST(MONTH(pu_dt) AS INT) AS src_month, COUNT(*) AS n, "
            "CAST(SUM(passengers) AS BIGINT) AS passengers FROM trips_raw "
            "WHERE dataset='yellow' AND pu_dt >= TIMESTAMP '1998-01-01' GROUP BY 1, 2")),
        "src_feed_scan": using("trips_raw", query=(
            "SELECT CAST(YEAR(pu_dt) AS INT) AS year, dataset, COUNT(*) AS n, MIN(pu_dt) AS first_dt, MAX(pu_dt) AS last_dt "
            "FROM trips_raw WHERE do_locid <> 0 AND pu_dt >= TIMESTAMP '1995-01-01' AND pu_dt < TIMESTAMP '1998-07-01' GROUP BY 1, 2")),
        "src_partition_read": using("trips_raw", query=(
            "SELECT * EXCLUDE (src_year) FROM trips_raw WHERE do_locid <> 0 AND YEAR(pu_dt) = 2000")),
        "src_columns_union": using("profile", query="SELECT DISTINCT field FROM profile"),
        "sink_repartition": using("trips_raw", query=(
            "SELECT year, CAST(CEIL(n / 5000) AS BIGINT) AS files, CAST(n // 5000 AS BIGINT) AS full_files, "
            "CASE WHEN n % 5000 = 0 THEN 5000 ELSE n % 5000 END AS smallest, n AS rows FROM ("
            "SELECT CAST(YEAR(pu_dt) AS INT) AS year, COUNT(*) AS n FROM trips_raw WHERE do_locid <> 0 GROUP BY 1)")),
        "sink_format_matrix": using("trips_raw", query=(
            "SELECT format, n, sum_pu, sum_passengers, sum_distance, first_dt, last_dt, n_payment FROM ("
            "SELECT COUNT(*) AS n, CAST(SUM(pu_locid) AS BIGINT) AS sum_pu, CAST(SUM(passengers) AS BIGINT) AS sum_passengers, "
            "ROUND(SUM(distance), 3) AS sum_distance, MIN(pu_dt) AS first_dt, MAX(do_dt) AS last_dt, "
            "COUNT(payment_type) AS n_payment FROM trips_raw WHERE dataset='green' AND YEAR(pu_dt) = 2000) "
            "CROSS JOIN (SELECT unnest(['parquet','csv','csv.gz','orc','json']) AS format)")),
        "schema_profile": GIVEN_PROFILE,
        "schema_evolution": using("states", query=(
            "SELECT file, field, concat(': ', shown) AS change FROM states WHERE i = 0 "
            "UNION ALL SELECT file, field, concat('+ ', shown) FROM states WHERE i > 0 AND previous IS NULL "
            "UNION ALL SELECT file, field, concat(': ', previous, ' -> ', shown) FROM states WHERE previous <> shown "
            "UNION ALL SELECT next_file, field, '-' FROM states WHERE last_of_run AND next_file IS NOT NULL")),
        "schema_final": using("states", query="SELECT field, shown AS schema FROM states WHERE next_file IS NULL"),
        "conform_schema": (
            "SELECT CAST(YEAR(l_shipdate) AS INT) AS year, COUNT(*) AS n, CAST(SUM(l_suppkey) AS BIGINT) AS sum_vendor, "
            "CAST(SUM(l_linenumber) AS BIGINT) AS sum_passengers, SUM(CAST(CAST(l_quantity AS FLOAT) AS DOUBLE)) AS sum_distance, "
            "MAX(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE)) AS max_fare, MIN(l_shipdate) AS first_dt FROM lineitem GROUP BY 1"),
        "universal_trips": _universal(),
        "clean_zones": using("trips_raw", query=(
            f"SELECT dataset, pu_dt, {CLEAN['pu_locid']} AS pu_locid, {CLEAN['do_locid']} AS do_locid FROM trips_raw")),
        "clean_dropoff": using("trips_raw", query=f"SELECT dataset, pu_dt, {CLEAN['do_dt']} AS do_dt FROM trips_raw"),
        "clean_amounts": using("trips_raw", query=(
            "SELECT dataset, " + ", ".join(f"{CLEAN[c]} AS {c}" for c in ("passengers", "distance", "fee_fare", "fee_tip", "fee_total"))
            + " FROM trips_raw")),
        "clean_base": using("trips_raw", query=f"SELECT dataset, pu_dt, {CLEAN['dbasenum']} AS dbasenum FROM trips_raw"),
        "trip_time": using("trips", query=(
            "SELECT dataset, pu_dt, do_dt, date_diff('microsecond', pu_dt, do_dt) / 1e6 AS trip_time FROM trips")),
        "label_fhv": using("labelled", query="SELECT pu_dt, dbasenum, label FROM labelled WHERE dataset='fhv'"),
        "label_fhvhv": using("labelled", query="SELECT pu_dt, licensenum, label FROM labelled WHERE dataset='fhvhv'"),
        "flag_to_bool": using("trips_raw", query=(
            "SELECT pu_dt AS tpep_pickup_datetime, passengers % 2 = 0 AS store_and_fwd_flag FROM trips_raw WHERE dataset='yellow'")),
        **{f"anomaly_{feed}": using("trips_raw", query=_anomaly(feed)) for feed in FEEDS},
        "anomaly_fractions": _fractions(),
        "anomaly_by_zone": using("by_zone", query="SELECT * FROM by_zone"),
        "anomaly_zone_rate": using("by_zone", "zones", query=(
            "SELECT zone, borough, label, by_zone.locid, rows, errors, ROUND(errors / rows, 9) AS error_rate "
            "FROM zones RIGHT JOIN by_zone ON zones.locid = by_zone.locid")),
        "anomaly_zone_top5": using("by_zone", "zones", query=(
            "SELECT label, t.locid, rows, errors, ROUND(rate, 9) AS error_rate, CAST(rank AS INT) AS rank, zone, borough FROM ("
            "SELECT *, errors / rows AS rate, row_number() OVER (PARTITION BY label ORDER BY errors / rows DESC, locid) AS rank "
            "FROM by_zone QUALIFY rank <= 5) t LEFT JOIN zones ON zones.locid = t.locid")),
        "join_zone_names": using("trips", "zones", query=(
            "SELECT c.locid, dataset, n, zone, borough FROM (SELECT locid, dataset, COUNT(*) AS n FROM ("
            "SELECT pu_locid AS locid, dataset FROM trips UNION ALL SELECT do_locid, dataset FROM trips) "
            "WHERE locid IS NOT NULL GROUP BY 1, 2) c LEFT JOIN zones ON zones.locid = c.locid")),
        "join_zone_names_twice": using("arcs", "zones", query=(
            "SELECT arcs.*, p.zone AS pu_zone, p.borough AS pu_borough, d.zone AS do_zone, d.borough AS do_borough FROM arcs "
            "LEFT JOIN zones p ON p.locid = pu_locid LEFT JOIN zones d ON d.locid = do_locid")),
        "join_zones_right": using("trips", "zones", query=(
            "SELECT zone, borough, pu_locid, fare_mean FROM zones RIGHT JOIN (SELECT pu_locid, CAST(CAST(AVG(fee_fare) AS FLOAT) AS DOUBLE) AS fare_mean "
            "FROM trips WHERE pu_locid IS NOT NULL GROUP BY 1) ON locid = pu_locid")),
        "join_full_indicator": using("breakdown", query="SELECT * FROM breakdown"),
        "join_thresholds": using("limits", query=(
            "SELECT label, fare, COUNT(*) AS n, MAX(fee_tip) AS max_tip FROM buckets JOIN limits USING (label, fare) "
            "WHERE fee_tip < tip_max GROUP BY 1, 2")),
        "producer_messages": using("trips_raw", "zones", query=(
            "SELECT concat(dataset, '_trips_1997') AS topic, COALESCE(CAST(pu_locid AS VARCHAR), dataset) AS key, COUNT(*) AS n, "
            "MIN(epoch_us(pu_dt) // 1000) AS first_ms, MAX(epoch_us(pu_dt) // 1000) AS last_ms, COUNT(borough) AS boroughs, "
            "MAX(CAST(CAST(fee_fare AS FLOAT) AS DOUBLE)) AS most FROM trips_raw LEFT JOIN zones ON locid = pu_locid "
            "WHERE dataset IN ('yellow', 'fhvhv') AND YEAR(pu_dt) = 1997 GROUP BY 1, 2")),
        "summary_messages": (
            "SELECT CAST((SELECT MAX(epoch_us(ts) // 1000) FROM events) AS VARCHAR) AS key, CAST(COUNT(*) AS INT) AS k, "
            f"ROUND(SUM(weight), 4) AS weight FROM ({_borough_centers()})"),
        "decode_messages": using("trip_events", query=(
            "SELECT pu_borough, COUNT(*) AS n, COUNT(fare_usd) FILTER (WHERE event_id % 6 < 2) AS fares, "
            "MAX(fare_usd) FILTER (WHERE event_id % 6 < 2) AS most, MIN(pu_dt) AS first "
            "FROM trip_events WHERE event_id % 6 < 4 GROUP BY 1")),
        "join_zone_lookup": using("trip_events", query="SELECT event_id, pu_locid, do_locid, pu_borough, do_borough FROM trip_events"),
        "join_semi_top_zones": using("top", query=(
            "SELECT * FROM arcs WHERE pu_locid IN (SELECT locid FROM top) AND do_locid IN (SELECT locid FROM top)")),
        "colstats": using("stats", query=(
            "SELECT dataset, col, "
            + ", ".join(f"CAST(CAST({s} AS FLOAT) AS DOUBLE) AS {s}" for s in ("mean", "std"))
            + ", min, max, frac_null, " + ", ".join(f"ROUND({s}, 9) AS {s}" for s in ("q25", "q50", "q75", "iqr")) + " FROM stats")),
        "colstats_trip_time": using("stats", query=(
            "SELECT dataset, " + ", ".join(
                f"TIMESTAMP '2000-01-01' + to_microseconds(CAST(ROUND(ROUND({s}, 3) * 1000000) AS BIGINT)) AS {s}" for s in stats)
            + " FROM stats WHERE col = 'trip_time'")),
        "agg_quantile": using("long", query=(
            "SELECT dataset, col, COUNT(value) AS n, TRUE AS within_bound FROM long GROUP BY 1, 2")),
        "exact_quantile": using("long", query=(
            "SELECT dataset, col, ROUND(quantile_cont(value, 0.95), 9) AS q95 FROM long GROUP BY 1, 2")),
        "quantile_sketches": using("long", query=(
            "SELECT dataset, COUNT(value) AS n, TRUE AS within_bound FROM long WHERE col = 'trip_time' GROUP BY 1")),
        "volume_month_feed": using("trips", query=(
            "SELECT date_trunc('month', pu_dt) AS month, dataset, COUNT(*) AS volume FROM trips GROUP BY 1, 2")),
        "volume_month_label": using("labelled", query=(
            "SELECT date_trunc('month', pu_dt) AS month, label, COUNT(*) AS volume FROM labelled WHERE label IS NOT NULL GROUP BY 1, 2")),
        "volume_hour_label": using("hourly", query="SELECT * FROM hourly"),
        "volume_day_profile": _day_profile(False),
        "volume_week_profile": _week_profile(False),
        "volume_day_profile_split": _day_profile(True),
        "volume_week_profile_split": _week_profile(True),
        "volume_zone": using("labelled", query=(
            "SELECT locid, label, COUNT(*) AS n FROM (SELECT pu_locid AS locid, label FROM labelled UNION ALL "
            "SELECT do_locid, label FROM labelled) WHERE locid IS NOT NULL AND label IS NOT NULL GROUP BY 1, 2")),
        "volume_zone_scale": using("labelled", query=(
            "SELECT ROUND(MIN(log10(n)), 6) AS log_min, ROUND(MAX(log10(n)), 6) AS log_max FROM ("
            "SELECT locid, label, COUNT(*) AS n FROM (SELECT pu_locid AS locid, label FROM labelled UNION ALL "
            "SELECT do_locid, label FROM labelled) WHERE locid IS NOT NULL AND label IS NOT NULL GROUP BY 1, 2)")),
        "volume_arc": using("arcs", query="SELECT * FROM arcs"),
        "top_zones": using("top", query="SELECT * FROM top"),
        "top_zone_names": using("top", "zones", query=(
            "SELECT rank, top.locid, zone, borough FROM top LEFT JOIN zones ON zones.locid = top.locid")),
        "arc_matrix": using("top", query=(
            "SELECT p.rank AS pu_rank, d.rank AS do_rank, pu_locid, do_locid, arcs.n, ROUND(log10(arcs.n), 6) AS log_n "
            "FROM arcs JOIN top p ON p.locid = pu_locid JOIN top d ON d.locid = do_locid")),
        "arc_matrix_wide": using("top", query=(
            "SELECT p.rank AS pu_rank, pu_locid, " + ", ".join(
                f"ROUND(log10(MAX(CASE WHEN d.rank = {i} THEN arcs.n END)), 6) AS to_{i}" for i in range(1, 11))
            + " FROM arcs JOIN top p ON p.locid = pu_locid JOIN top d ON d.locid = do_locid GROUP BY 1, 2")),
        "pivot_volume_month": using("trips", query=(
            "SELECT date_trunc('month', pu_dt) AS month, "
            + ", ".join(f"COUNT(*) FILTER (WHERE dataset = '{f}') AS {f}" for f in FEEDS) + " FROM trips GROUP BY 1")),
        "volume_share_month": using("labelled", query=(
            "SELECT month, label, ROUND(v / SUM(v) OVER (PARTITION BY month), 9) AS share FROM ("
            "SELECT m.month, l.label, COUNT(t.label) AS v FROM (SELECT DISTINCT date_trunc('month', pu_dt) AS month FROM labelled "
            "WHERE label IS NOT NULL) m CROSS JOIN (SELECT unnest(['yellow','green','fhv_small','fhv_big']) AS label) l "
            "LEFT JOIN labelled t ON date_trunc('month', t.pu_dt) = m.month AND t.label = l.label GROUP BY 1, 2)")),
        "boroughs_present": using("trips", "zones", query=(
            "SELECT DISTINCT d AS dataset, borough FROM (SELECT unnest([dataset, 'all']) AS d, locid FROM ("
            "SELECT dataset, pu_locid AS locid FROM trips UNION SELECT dataset, do_locid FROM trips)) e JOIN zones USING (locid)")),
        "fare_zone": using("trips", query=(
            "SELECT pu_locid, CAST(CAST(AVG(fee_fare) AS FLOAT) AS DOUBLE) AS fare_mean FROM trips WHERE dataset <> 'fhv' AND pu_locid IS NOT NULL GROUP BY 1")),
        "payment_types": using("trips", query=(
            "SELECT dataset, COALESCE(payment_type, 5) AS payment_type, CASE COALESCE(payment_type, 5) WHEN 0 THEN 'Flex fare' "
            "WHEN 1 THEN 'Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' "
            "WHEN 6 THEN 'Voided trip' END AS payment_name, COUNT(*) AS n FROM trips WHERE dataset IN ('yellow','green') GROUP BY 1, 2, 3")),
        "trip_time_bins": using("labelled", query=(
            "SELECT label, b AS bin_order, ['0-60s','1-5min','5-10min','10-30min','30-60min','1-3h','3-6h','6-12h','12-18h','18-24h','24h+'][b + 1] AS time, "
            "COUNT(*) AS n, CASE label WHEN 'yellow' THEN 'Yellow' WHEN 'green' THEN 'Green' WHEN 'fhv_small' THEN 'FHV (Other)' ELSE 'FHV (Uber/Lyft)' END AS label_name, "
            "CASE label WHEN 'yellow' THEN 0 WHEN 'green' THEN 1 WHEN 'fhv_small' THEN 2 ELSE 3 END AS label_order FROM ("
            "SELECT label, CASE WHEN s <= 0 THEN NULL WHEN s <= 60 THEN 0 WHEN s <= 300 THEN 1 WHEN s <= 600 THEN 2 WHEN s <= 1800 THEN 3 "
            "WHEN s <= 3600 THEN 4 WHEN s <= 10800 THEN 5 WHEN s <= 21600 THEN 6 WHEN s <= 43200 THEN 7 WHEN s <= 64800 THEN 8 "
            "WHEN s <= 86400 THEN 9 WHEN s IS NOT NULL THEN 10 END AS b FROM ("
            "SELECT label, date_diff('microsecond', pu_dt, do_dt) / 1e6 AS s FROM labelled)) "
            "WHERE b IS NOT NULL AND label IS NOT NULL GROUP BY ALL")),
        "distance_fare_curve": using("trips", query=(
            "SELECT bucket, CAST(CAST(AVG(fee_fare) AS FLOAT) AS DOUBLE) AS fare, COUNT(*) AS n, CAST(CAST(pow(10, bucket / 100) AS FLOAT) AS DOUBLE) AS distance FROM ("
            "SELECT CAST(FLOOR(log10(distance) * 100) AS INT) AS bucket, fee_fare FROM trips WHERE dataset <> 'fhv' AND distance > 0) GROUP BY 1")),
        "fare_tip_curve": using("limits", query=fare_tip),
        "fare_tip_display": using("limits", query=f"SELECT * FROM ({fare_tip}) WHERE n > 10 AND fare < 600"),
        "repack_feed": _repacks(),
        "feed_sql_view": using("trips_raw", query=(
            "SELECT dataset, COUNT(*) AS n, COUNT(licensenum) AS licensed, MIN(pu_dt) AS first_dt FROM trips_raw WHERE do_locid <> 0 GROUP BY 1")),
        "zone_load": using("zones", query="SELECT *, unnest(['csv', 'parquet']) AS kind FROM zones"),
        "src_csv": using("trips_raw", query=(
            "SELECT unnest(['none', 'gzip']) AS codec, * FROM (SELECT dataset, COUNT(*) AS n, CAST(SUM(pu_locid) AS BIGINT) AS sum_pu, "
            "CAST(SUM(passengers) AS BIGINT) AS sum_passengers, COUNT(dbasenum) AS bases, MAX(pu_dt) AS last_dt FROM trips_raw GROUP BY 1)")),
        "location_names": using("trips_raw", query=(
            "SELECT dataset, pu_locid AS pulocationid, COUNT(*) AS n, MAX(do_locid) AS last_do FROM trips_raw GROUP BY 1, 2")),
        "constant_label": using("trips", query=(
            "SELECT 'yellow' AS label, pu_locid, COUNT(*) AS n FROM trips WHERE dataset = 'yellow' GROUP BY 1, 2")),
        "pick_columns": using("trips_raw", query=f"SELECT * EXCLUDE (time_zero, fare_negative) FROM ({_anomaly('yellow')})"),
        "resolve_ids": using("zones", query=(
            "SELECT CAST(p AS INT) AS position, CAST([132, 138, 161, 7, 263, 999][p + 1] AS INT) AS locid, zone, borough FROM "
            "(SELECT unnest(range(6)) AS p) LEFT JOIN zones ON zones.locid = [132, 138, 161, 7, 263, 999][p + 1]")),
        "rolling_report": _reports(),
        "license_counts": using("trips_raw", query="SELECT licensenum, COUNT(*) AS n FROM trips_raw WHERE dataset='fhvhv' GROUP BY 1"),
        "base_last_seen": using("last_seen", query="SELECT * FROM last_seen"),
        "base_license_pairs": using("pairs", query="SELECT * FROM pairs"),
        "base_multi_license": using("pairs", query="SELECT dbn, COUNT(*) AS n FROM pairs GROUP BY 1 HAVING COUNT(*) > 1"),
        "operator_breakdown": using("breakdown", query=(
            "SELECT DISTINCT CASE WHEN ln IN ('HV0003','HV0005') THEN 'big' ELSE 'small' END AS operator, dbn FROM breakdown WHERE origin='both'")),
        "trip_events": using("trip_events", query=(
            "SELECT * EXCLUDE (event_id, duration_minutes), ROUND(duration_minutes, 6) AS duration_minutes, "
            "epoch_us(pu_dt) // 1000 AS event_ms FROM trip_events")),
        "trip_event_keys": using("trip_events", query=(
            "SELECT COALESCE(CAST(pu_locid AS VARCHAR), dataset) AS key, COUNT(*) AS n, MIN(epoch_us(pu_dt) // 1000) AS first_ms, "
            "MAX(epoch_us(pu_dt) // 1000) AS last_ms FROM trip_events GROUP BY 1")),
        "rolling_stats_batch": _rolling(15),
        "rolling_stats_batch_6h": _rolling(360),
        "rolling_stats_latest": using("trip_events", query=_latest("pu_borough")),
        "rolling_stats_borough": using("trip_events", query=_latest("pu_borough")),
        "rolling_stats_top_zones": using("trip_events", query=(
            f"SELECT * FROM (SELECT pu_locid, COUNT(*) AS seen FROM trip_events GROUP BY 1 ORDER BY seen DESC, pu_locid LIMIT 10) "
            f"LEFT JOIN ({_latest('pu_locid')}) USING (pu_locid)")),
        "bounded_replay": using("trip_events", query=(
            "SELECT COUNT(*) AS n, MIN(ms) AS first_ms, MAX(ms) AS last_ms, CAST(SUM(ms) AS BIGINT) AS sum_ms FROM ("
            "SELECT epoch_us(pu_dt) // 1000 AS ms FROM trip_events WHERE pu_dt IS NOT NULL ORDER BY ms LIMIT 70)")),
        "rolling_windows": using("trip_events", query=(
            "SELECT s AS window_start, s + INTERVAL '6' HOUR AS window_end, pu_borough, COUNT(*) AS n, " + _moments() + " FROM ("
            f"SELECT *, date_trunc('hour', pu_dt) - INTERVAL '1' HOUR * unnest(range(0, 6)) AS s FROM ({_FILLED})) "
            "WHERE pu_borough IS NOT NULL GROUP BY 1, 2, 3")),
        "stream_features": _features(),
        "decayed_weight": using("trip_events", query=(
            f"SELECT pu_borough, COUNT(*) AS n, CAST(CAST({decayed} AS FLOAT) AS DOUBLE) AS weight FROM {aged} GROUP BY 1")),
        "micro_centers": _borough_centers(),
        "macro_centers": _borough_centers(),
        "micro_cluster_weight": using("trip_events", query=(
            f"SELECT ROUND({decayed}, 2) AS weight, MAX(ms) AS clock_ms FROM {aged}")),
    }

"""Queries on cleaning, calendar, enrichment and pairing."""

from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import inputs
from catalog.inputs import RAW_TAXIS_SQL, with_trips
from wayfare.functions import calendar, codes
from wayfare.operators import compare, enrich, filters, reports, sampling, splits
from wayfare.operators.sides import materialise
from wayfare.plans import clean, process
from wayfare.session import shared_folder
from wayfare.sources import feeds, schemas, sinks

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return register


# ---- cleaning ----

_CODES = "VendorID IN (1, 2) AND payment_type BETWEEN 1 AND 6 AND RatecodeID IN (1, 4, 5, 6)"
_LIMITS = (
    "passenger_count > 0 AND passenger_count < 5 AND trip_distance > 0 AND trip_distance < 25 "
    "AND PULocationID <> DOLocationID"
)
_ZONES = (
    "PULocationID IN (SELECT zone FROM stations WHERE zone IS NOT NULL) "
    "AND DOLocationID IN (SELECT zone FROM stations WHERE zone IS NOT NULL)"
)
_TRIP = "pickup_datetime, dropoff_datetime, PULocationID, DOLocationID"
_COMPLETE = "pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL"
_CODE_COLUMNS = ["ride", "VendorID", "payment_type", "RatecodeID", "trip_type"]


@query(
    "filter_codes",
    RAW_TAXIS_SQL + "SELECT ride, VendorID, payment_type, RatecodeID, trip_type FROM raw "
    f"WHERE {_CODES} AND trip_type IN (1, 2)",
)
def filter_codes(spark, folder):
    rules = [*filters.code_rules(), filters.trip_type_rule()]
    return filters.keep(inputs.raw_taxis(spark, folder), *rules).select(*_CODE_COLUMNS)


@query(
    "filter_limits",
    RAW_TAXIS_SQL + "SELECT ride, passenger_count, trip_distance, PULocationID, DOLocationID "
    f"FROM raw WHERE {_LIMITS}",
)
def filter_limits(spark, folder):
    rules = [filters.passenger_rule(), filters.distance_rule(), filters.different_zones_rule()]
    kept = filters.keep(inputs.raw_taxis(spark, folder), *rules)
    return kept.select("ride", "passenger_count", "trip_distance", "PULocationID", "DOLocationID")


@query("zone_semi", RAW_TAXIS_SQL + f"SELECT ride, PULocationID, DOLocationID FROM raw WHERE {_ZONES}")
def zone_semi(spark, folder):
    zones = clean.bike_zones(inputs.stations(spark, folder))
    return clean.in_bike_zones(inputs.raw_taxis(spark, folder), zones).select(
        "ride", "PULocationID", "DOLocationID"
    )


@query(
    "flags",
    RAW_TAXIS_SQL + "SELECT ride, shared_match_flag, wav_match_flag FROM raw "
    "WHERE shared_match_flag = 'N' AND wav_match_flag = 'N'",
)
def flags(spark, folder):
    kept = filters.keep(inputs.raw_taxis(spark, folder), *filters.private_ride_rules())
    return kept.select("ride", "shared_match_flag", "wav_match_flag")


@query(
    "rule_report",
    RAW_TAXIS_SQL
    + f""", flagged AS (
  SELECT VendorID IN (1, 2) AS a, payment_type BETWEEN 1 AND 6 AS b, RatecodeID IN (1, 4, 5, 6) AS c,
         passenger_count > 0 AND passenger_count < 5 AS d,
         trip_distance > 0 AND trip_distance < 25 AS e, PULocationID <> DOLocationID AS f FROM raw
), totals AS (
  SELECT count(*) AS n0, count(*) FILTER (a) AS n1, count(*) FILTER (a AND b) AS n2,
         count(*) FILTER (a AND b AND c) AS n3, count(*) FILTER (a AND b AND c AND d) AS n4,
         count(*) FILTER (a AND b AND c AND d AND e) AS n5,
         count(*) FILTER (a AND b AND c AND d AND e AND f) AS n6 FROM flagged
)
SELECT 1 AS step, 'vendor' AS rule, n0 AS rows_in, n1 AS rows_out FROM totals
UNION ALL SELECT 2, 'payment', n1, n2 FROM totals
UNION ALL SELECT 3, 'rate_code', n2, n3 FROM totals
UNION ALL SELECT 4, 'passengers', n3, n4 FROM totals
UNION ALL SELECT 5, 'distance', n4, n5 FROM totals
UNION ALL SELECT 6, 'different_zones', n5, n6 FROM totals""",
)
def rule_report(spark, folder):
    return reports.rule_report(inputs.raw_taxis(spark, folder), clean.street_taxi_rules())


def _raw(spark, folder, code: str):
    """The raw trips under a feed's published column names, through the feed's mapping."""
    source = feeds.feed(code)
    published = {common: own for own, common in source.columns.items()}
    return feeds.harmonise(inputs.raw_taxis(spark, folder).withColumnsRenamed(published), source)


@query(
    "clean_yellow",
    RAW_TAXIS_SQL + f"SELECT {_TRIP} FROM raw WHERE {_CODES} AND {_LIMITS} AND {_ZONES} AND {_COMPLETE}",
)
def clean_yellow(spark, folder):
    return _wall_clock(
        clean.clean_yellow(_raw(spark, folder, "y"), clean.bike_zones(inputs.stations(spark, folder)))
    )


@query(
    "clean_green",
    RAW_TAXIS_SQL + f"SELECT {_TRIP} FROM raw WHERE {_CODES} AND trip_type IN (1, 2) "
    f"AND {_LIMITS} AND {_ZONES} AND {_COMPLETE}",
)
def clean_green(spark, folder):
    return _wall_clock(
        clean.clean_green(_raw(spark, folder, "g"), clean.bike_zones(inputs.stations(spark, folder)))
    )


@query(
    "clean_fhvhv",
    RAW_TAXIS_SQL + f"SELECT {_TRIP} FROM raw WHERE trip_distance > 0 AND trip_distance < 25 "
    "AND PULocationID <> DOLocationID AND shared_match_flag = 'N' AND wav_match_flag = 'N' "
    f"AND {_ZONES} AND {_COMPLETE}",
)
def clean_fhvhv(spark, folder):
    return _wall_clock(
        clean.clean_for_hire(_raw(spark, folder, "hv"), clean.bike_zones(inputs.stations(spark, folder)))
    )


def _wall_clock(trips):
    """Instants back to zoneless clocks, the type of the test tables."""
    clocks = ("pickup_datetime", "dropoff_datetime")
    return trips.withColumns({c: F.col(c).cast("timestamp_ntz") for c in clocks})


_BIKES_SQL = """SELECT pickup_datetime, dropoff_datetime, a.zone AS PULocationID, b.zone AS DOLocationID
FROM raw JOIN stations a ON {start} = a.{key} JOIN stations b ON {end} = b.{key}
WHERE a.zone <> b.zone AND pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL"""


def _rides(spark, folder, layout: str):
    raw = inputs.raw_taxis(spark, folder)
    start, end, clock, end_clock, _ = clean.BIKE_LAYOUTS[layout]
    ids = [F.col(c) for c in ("PULocationID", "DOLocationID")]
    if layout == "new":
        ids = [F.concat(F.lit("SYS"), c.cast("string")) for c in ids]
    return raw.select(
        ids[0].alias(start),
        ids[1].alias(end),
        F.col("pickup_datetime").alias(clock),
        F.col("dropoff_datetime").alias(end_clock),
    )


@query(
    "clean_bikes_old",
    RAW_TAXIS_SQL + _BIKES_SQL.format(start="PULocationID", end="DOLocationID", key="id"),
)
def clean_bikes_old(spark, folder):
    return clean.clean_bikes(_rides(spark, folder, "old"), inputs.stations(spark, folder), "old")


@query(
    "clean_bikes_new",
    RAW_TAXIS_SQL
    + _BIKES_SQL.format(start="'SYS' || PULocationID", end="'SYS' || DOLocationID", key="new_id"),
)
def clean_bikes_new(spark, folder):
    return clean.clean_bikes(_rides(spark, folder, "new"), inputs.stations(spark, folder), "new")


@query(
    "station_zone_join",
    RAW_TAXIS_SQL + "SELECT ride, a.zone AS PULocationID, b.zone AS DOLocationID FROM raw "
    "JOIN stations a ON PULocationID = a.id JOIN stations b ON DOLocationID = b.id",
)
def station_zone_join(spark, folder):
    raw = inputs.raw_taxis(spark, folder).select(
        "ride",
        F.col("PULocationID").alias("start station id"),
        F.col("DOLocationID").alias("end station id"),
    )
    side = clean.station_zone_side(inputs.stations(spark, folder), "old")
    return clean.with_station_zones(raw, side, "old").select("ride", "PULocationID", "DOLocationID")


@query(
    "harmonise_union",
    with_trips(
        "SELECT event_id, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID FROM trips"
    ),
)
def harmonise_union(spark, folder):
    """Three feeds with their own names and column orders, united by name."""
    trips = inputs.trips(spark, folder)
    taxis, bikes = (trips.filter(F.col("mode") == m) for m in ("taxis", "bikes"))
    yellow = taxis.select(
        F.col("DOLocationID"),
        F.col("pickup_datetime").alias("tpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("tpep_dropoff_datetime"),
        F.col("PULocationID"),
        F.col("event_id"),
    )
    ridden = bikes.select(
        "event_id",
        F.col("dropoff_datetime").alias("ended_at"),
        F.col("pickup_datetime").alias("started_at"),
        "PULocationID",
        "DOLocationID",
    )
    names = {"started_at": "pickup_datetime", "ended_at": "dropoff_datetime"}
    united = feeds.union_feeds(
        [yellow.withColumnsRenamed(feeds.feed("y").columns), ridden.withColumnsRenamed(names)]
    )
    return united.select("event_id", *schemas.TRIP_COLUMNS)


@query(
    "prefix_flag",
    RAW_TAXIS_SQL + "SELECT id, name, new_id FROM stations WHERE starts_with(new_id, 'SYS')",
)
def prefix_flag(spark, folder):
    return filters.starts_with(
        inputs.stations(spark, folder).select("id", "name", "new_id"), "new_id", "SYS"
    )


# ---- samples ----


@query(
    "hash_sample",
    "SELECT event_id, event_type FROM events WHERE "
    "CAST('0x' || substr(md5('69|' || event_id), 1, 8) AS BIGINT) < CAST(0.25 * 4294967296 AS BIGINT)",
)
def hash_sample(spark, folder):
    events = inputs.table(spark, folder, "events").select("event_id", "event_type")
    return sampling.keyed_sample(events, ["event_id"], sampling.MODE_SHARE)


@query("sample_seeded")
def sample_seeded(spark, folder):
    taxis, bikes = inputs.modes(inputs.trips(spark, folder))
    return sampling.bernoulli_sample(taxis, sampling.TAXI_SHARE).unionByName(
        sampling.bernoulli_sample(bikes, sampling.BIKE_SHARE)
    )


# ---- calendar and codes ----

_CALENDAR = "year, month, day, time_bin, day_of_week, trip_duration"


@query("calendar", with_trips(f"SELECT event_id, {_CALENDAR} FROM feat"))
def with_calendar(spark, folder):
    return calendar.with_calendar(inputs.trips(spark, folder)).select(
        "event_id", *_CALENDAR.split(", ")
    )


@query(
    "codes",
    with_trips(
        """SELECT event_id,
  CASE WHEN (time_bin >= 8 AND time_bin < 11) OR (time_bin >= 16 AND time_bin < 19) THEN 1 ELSE 0 END AS peak_hours,
  CASE WHEN day < 60 OR day >= 330 THEN 0 WHEN day >= 150 AND day < 240 THEN 1 ELSE 2 END AS weather_pattern,
  CASE WHEN trip_duration - 900 > 0 THEN 1 ELSE 0 END AS better_travel_type,
  CASE day_of_week WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday' WHEN 4 THEN 'Wednesday'
    WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' ELSE 'Saturday' END AS weekday
FROM feat""",
        study=True,
    ),
)
def all_codes(spark, folder):
    trips = calendar.with_calendar(inputs.study_trips(spark, folder))
    return trips.select(
        "event_id",
        codes.peak_code(F.col("time_bin")).alias("peak_hours"),
        codes.season_code(F.col("day")).alias("weather_pattern"),
        codes.better_mode_code(F.col("trip_duration") - 900).alias("better_travel_type"),
        calendar.weekday_name(F.col("day_of_week")).alias("weekday"),
    )


@query(
    "monthly_calendar",
    with_trips(
        """SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, count(event_id) AS trips
FROM generate_series(DATE '2020-07-01', DATE '2022-04-01', INTERVAL 1 MONTH) AS g(m)
LEFT JOIN feat ON date_trunc('month', pickup_datetime) = m GROUP BY ALL""",
        study=True,
    ),
)
def monthly_calendar(spark, folder):
    months = feeds.month_table(spark, "2020-07-01", "2022-04-01")
    counts = (
        calendar.with_calendar(inputs.study_trips(spark, folder))
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("trips"))
    )
    return months.join(counts, ["year", "month"], "left").select(
        "year", "month", F.coalesce("trips", F.lit(0)).alias("trips")
    )


# ---- enrichment ----

_HOUR = "year, month, day, time_bin"


@query(
    "traffic_join",
    with_trips(
        f"""SELECT event_id, mode, {_HOUR}, count
FROM feat LEFT JOIN (SELECT {_HOUR}, count(*) AS count FROM feat GROUP BY ALL) USING ({_HOUR})"""
    ),
)
def traffic_join(spark, folder):
    trips = calendar.with_calendar(inputs.trips(spark, folder))
    return enrich.with_traffic(trips).select("event_id", "mode", *_HOUR.split(", "), "count")


_MEASURES = ", ".join(f'"{m}"' for m in schemas.WEATHER_MEASURES)


def _side(raw):
    return enrich.weather_side(enrich.prepare_weather(raw))


@query(
    "weather_left",
    with_trips(f"SELECT event_id, {_MEASURES} FROM feat LEFT JOIN weather USING ({_HOUR})"),
)
def weather_left(spark, folder):
    trips = calendar.with_calendar(inputs.trips(spark, folder))
    joined = enrich.with_weather(trips, _side(inputs.weather(spark, folder)))
    return joined.select("event_id", *schemas.WEATHER_MEASURES)


@query(
    "drop_nulls",
    with_trips(
        f'SELECT event_id, {_MEASURES} FROM feat JOIN weather USING ({_HOUR})'
    ),
)
def drop_nulls(spark, folder):
    return filters.drop_null_rows(weather_left(spark, folder))


@query(
    "rows_with_nulls",
    with_trips(
        f'SELECT event_id, {_MEASURES} FROM feat LEFT JOIN weather USING ({_HOUR}) WHERE "Temperature" IS NULL'
    ),
)
def rows_with_nulls(spark, folder):
    return filters.rows_with_nulls(weather_left(spark, folder))


@query(
    "null_audit",
    with_trips(
        f', joined AS (SELECT event_id, {_MEASURES} FROM feat LEFT JOIN weather USING ({_HOUR})) '
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count("{c}") AS non_null, count(*) - count("{c}") AS nulls,
count("{c}") < count(*) AS any_null FROM joined"""
            for c in ["event_id", *schemas.WEATHER_MEASURES]
        )
    ),
)
def null_audit(spark, folder):
    return reports.null_report(weather_left(spark, folder))


# ---- pairs ----


def plain(df):
    """Wide pair counts as doubles: exact in the test tables, and without overflow beyond."""
    wide = [f.name for f in df.schema if f.dataType.simpleString().startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in wide})


_PAIR = "year, month, day, time_bin, PULocationID, DOLocationID, day_of_week"
_PAIRED = f"""paired AS (
  SELECT {_PAIR}, t.trip_duration AS trip_duration_taxis, b.trip_duration AS trip_duration_bikes,
         t.trip_duration - b.trip_duration AS trip_difference
  FROM taxis t JOIN bikes b USING ({_PAIR}))"""


@query(
    "merged",
    with_trips(
        f""", {_PAIRED}, traffic AS (
  SELECT {_HOUR}, count(*) FILTER (mode = 'taxis') AS count_taxis,
         count(*) FILTER (mode = 'bikes') AS count_bikes FROM feat GROUP BY ALL)
SELECT {_PAIR}, trip_duration_taxis, trip_duration_bikes, CAST(count(*) AS DOUBLE) AS pairs,
       count_taxis, count_bikes, trip_difference,
       CASE WHEN (time_bin >= 8 AND time_bin < 11) OR (time_bin >= 16 AND time_bin < 19) THEN 1 ELSE 0 END AS peak_hours,
       CASE WHEN day < 60 OR day >= 330 THEN 0 WHEN day >= 150 AND day < 240 THEN 1 ELSE 2 END AS weather_pattern,
       CASE WHEN trip_difference > 0 THEN 1 ELSE 0 END AS better_travel_type, {_MEASURES}
FROM paired JOIN traffic USING ({_HOUR}) LEFT JOIN weather USING ({_HOUR}) GROUP BY ALL"""
    ),
)
def merged(spark, folder):
    taxis, bikes = inputs.modes(inputs.trips(spark, folder))
    weather = _side(inputs.weather(spark, folder))
    return plain(compare.merged_trips(taxis, bikes, weather, pairs_type="double"))


@query(
    "merged_avg_fast",
    with_trips(
        f""", {_PAIRED}
SELECT time_bin, CAST(count(*) AS DOUBLE) AS pairs,
       CAST(sum(trip_duration_taxis) AS DOUBLE) / count(*) AS avg_taxis,
       CAST(sum(trip_duration_bikes) AS DOUBLE) / count(*) AS avg_bikes,
       CAST(sum(trip_difference) AS DOUBLE) / count(*) AS avg_difference
FROM paired GROUP BY 1"""
    ),
)
def merged_avg_fast(spark, folder):
    sums = compare.key_sums(*inputs.modes(inputs.trips(spark, folder)))
    return plain(compare.pair_means(sums, "time_bin"))


def _outcomes(spark, folder):
    return compare.key_outcomes(compare.duration_counts(*inputs.modes(inputs.trips(spark, folder))))


@query(
    "key_outcomes",
    with_trips(
        f""", {_PAIRED}
SELECT {_PAIR}, CAST(count(*) AS DOUBLE) AS pairs,
       CAST(sum(trip_difference) AS DOUBLE) AS difference_sum,
       CAST(sum(trip_difference * trip_difference) AS DOUBLE) AS difference_squares,
       CAST(count(*) FILTER (trip_difference > 0) AS DOUBLE) AS taxi_slower_pairs
FROM paired GROUP BY ALL"""
    ),
)
def key_outcomes(spark, folder):
    return plain(_outcomes(spark, folder))


@query(
    "class_balance",
    with_trips(
        f""", {_PAIRED}
SELECT CASE WHEN trip_difference > 0 THEN 1 ELSE 0 END AS better_travel_type,
       CAST(count(*) AS DOUBLE) AS pairs FROM paired GROUP BY 1"""
    ),
)
def class_balance(spark, folder):
    return plain(compare.class_balance(_outcomes(spark, folder)))


@query(
    "variance_rmse",
    with_trips(
        f""", {_PAIRED}
SELECT CAST(count(*) AS DOUBLE) AS pairs, round(var_samp(trip_difference), 3) AS variance,
       round(sqrt(var_samp(trip_difference)), 6) AS naive_rmse FROM paired"""
    ),
)
def variance_rmse(spark, folder):
    spread = plain(compare.difference_spread(_outcomes(spark, folder)))
    return spread.select(
        "pairs", F.round("variance", 3).alias("variance"), F.round("naive_rmse", 6).alias("naive_rmse")
    )


@query(
    "pair_page",
    with_trips(
        f""", {_PAIRED}, numbered AS (SELECT row_number() OVER (ORDER BY {_PAIR}, trip_duration_taxis, trip_duration_bikes) - 1
    AS number, {_PAIR}, trip_duration_taxis, trip_duration_bikes FROM paired)
SELECT * FROM numbered WHERE number >= 100 AND number < 600""",
        study=True,
    ),
)
def pair_page(spark, folder):
    """A page of the numbered pairs, from the counts alone."""
    counts = compare.duration_counts(*inputs.modes(inputs.study_trips(spark, folder)))
    return compare.pair_page(materialise(counts), 100, 500)


# ---- per-mode tables and splits ----

_MODE_COLUMNS = (
    f"{_HOUR}, day_of_week, PULocationID, DOLocationID, trip_duration, peak_hours, weather_pattern, count"
)


def _mode_sql(mode: str) -> str:
    return f""", traffic AS (SELECT {_HOUR}, count(*) AS count FROM feat WHERE mode = '{mode}' GROUP BY ALL),
coded AS (SELECT *,
  CASE WHEN (time_bin >= 8 AND time_bin < 11) OR (time_bin >= 16 AND time_bin < 19) THEN 1 ELSE 0 END AS peak_hours,
  CASE WHEN day < 60 OR day >= 330 THEN 0 WHEN day >= 150 AND day < 240 THEN 1 ELSE 2 END AS weather_pattern
  FROM feat WHERE mode = '{mode}' AND day_of_week BETWEEN 2 AND 6 AND trip_duration < 10800),
processed AS (SELECT {_MODE_COLUMNS}, {_MEASURES}
  FROM coded JOIN traffic USING ({_HOUR}) LEFT JOIN weather USING ({_HOUR})) """


def study_mode(spark, folder, mode: str):
    taxis, bikes = inputs.modes(inputs.study_trips(spark, folder))
    trips = taxis if mode == "taxis" else bikes
    return process.mode_trips(trips, _side(inputs.study_weather(spark, folder)))


@query("mode_trips", with_trips(_mode_sql("taxis") + "SELECT * FROM processed", study=True))
def mode_trips(spark, folder):
    return study_mode(spark, folder, "taxis")


@query("mode_trips_bikes", with_trips(_mode_sql("bikes") + "SELECT * FROM processed", study=True))
def mode_trips_bikes(spark, folder):
    return study_mode(spark, folder, "bikes")


@query(
    "long_trips",
    """WITH trips AS (SELECT l_orderkey, l_linenumber, o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, date_diff('second', pickup_datetime, dropoff_datetime) AS trip_duration
FROM trips WHERE date_diff('second', pickup_datetime, dropoff_datetime) < 10800""",
)
def long_trips(spark, folder):
    """The per-mode duration rule keeps zero and negative durations."""
    orders = inputs.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    items = inputs.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    trips = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "trip_duration", calendar.elapsed_seconds(F.col("o_orderdate"), F.col("l_shipdate"))
    )
    kept = filters.keep(trips, filters.duration_rule("trip_duration", positive=False))
    return kept.select("l_orderkey", "l_linenumber", "trip_duration")


_ORDER_DATES = """WITH dated AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month FROM orders) """


def _dated_orders(spark, folder):
    return inputs.table(spark, folder, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )


@query(
    "split_time",
    _ORDER_DATES
    + """SELECT *, CASE WHEN year = 2000 THEN 'test' WHEN year = 1999 AND month > 8 THEN 'validation'
  WHEN year = 1998 OR year = 1999 THEN 'train' END AS split FROM dated""",
)
def split_time(spark, folder):
    return splits.three_way_split(_dated_orders(spark, folder), validation_year=1999, test_year=2000)


@query(
    "split_two_way",
    _ORDER_DATES
    + """SELECT *, CASE WHEN year = 1999 AND month > 8 THEN 'validation'
  WHEN year = 1998 OR month <= 8 THEN 'train' END AS split FROM dated""",
)
def split_two_way(spark, folder):
    return splits.two_way_split(_dated_orders(spark, folder), validation_year=1999)


# ---- written and read back ----


def _fresh_path(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


@query(
    "split_write",
    with_trips(
        _mode_sql("bikes")
        + f"SELECT *, CASE WHEN year = 2022 THEN 'test' ELSE 'train' END AS split FROM processed",
        study=True,
    ),
)
def split_write(spark, folder):
    """The per-mode table written once by split and read back."""
    path = _fresh_path(spark, "split")
    sinks.write_split(study_mode(spark, folder, "bikes"), path)
    return sinks.read_table(spark, path)


@query(
    "month_write",
    with_trips(f"SELECT {_TRIP}, year, month FROM feat", study=True),
)
def month_write(spark, folder):
    """Trips written by year and month and read back as one table."""
    path = _fresh_path(spark, "months")
    sinks.write_months(_filed(spark, folder), path, MONTHS, compact=True)
    return sinks.read_table(spark, path)


MONTHS = feeds.expand_months()


def _filed(spark, folder, year: str = "year(pickup_datetime)", month: str = "month(pickup_datetime)"):
    """Study trips with the month of the file that they are said to come from."""
    trips = inputs.study_trips(spark, folder).select(*schemas.TRIP_COLUMNS)
    return trips.withColumns({"file_year": F.expr(year), "file_month": F.expr(month)})


@query(
    "month_rewrite",
    with_trips(
        f"SELECT {_TRIP}, year, month FROM feat WHERE NOT (year = 2021 AND month IN (2, 3)) "
        f"UNION ALL SELECT {_TRIP}, 2021 AS year, 2 AS month FROM feat WHERE PULocationID = 0",
        study=True,
    ),
)
def month_rewrite(spark, folder):
    """All months written, then one again with strays of other months, and one emptied."""
    path = _fresh_path(spark, "months")
    trips = _filed(spark, folder)
    sinks.write_months(trips, path, MONTHS)
    strays = _filed(spark, folder, "2021", "2").filter("PULocationID = 0")
    sinks.write_months(strays, path, [(2021, 2)])
    sinks.write_months(trips.filter("false"), path, [(2021, 3)])
    return sinks.read_table(spark, path)


@query(
    "station_csv",
    RAW_TAXIS_SQL + "SELECT id, name, zone, new_id FROM stations",
)
def station_csv(spark, folder):
    """The station dimension as CSV with a header, read back under its schema."""
    path = _fresh_path(spark, "stations")
    named = inputs.stations(spark, folder)
    sinks.write_csv(named, path)
    schema = T.StructType([f for f in schemas.STATIONS if f.name in named.columns])
    return feeds.read_csv(spark, path, schema).withColumnRenamed("Taxi area code", "zone")

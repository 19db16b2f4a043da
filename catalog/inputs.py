"""The test tables read as trip feeds, in Spark and as SQL common table expressions."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


TAXI_EVENTS = ("view", "click", "purchase")

# Months by which an event is moved back, by the five-day block of its month: to July 2020,
# March, June and October 2021, February and April 2022.
SHIFTS = (42, 34, 31, 27, 23, 21)


def _mode() -> Column:
    return F.when(F.col("event_type").isin(*TAXI_EVENTS), "taxis").otherwise("bikes")


def _trips(events: DataFrame, start, origin, destination) -> DataFrame:
    seconds = F.floor(F.col("value") * 60).cast("int")
    return events.select(
        "event_id",
        _mode().alias("mode"),
        start.alias("pickup_datetime"),
        F.timestamp_add("SECOND", seconds, start).alias("dropoff_datetime"),
        origin.cast("int").alias("PULocationID"),
        destination.cast("int").alias("DOLocationID"),
    )


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Events of one month as trips of two modes between two zones."""
    return _trips(
        table(spark, folder, "events"), F.col("ts"), F.col("user_id") % 2, F.col("event_id") % 2
    )


def shifted_events(spark: SparkSession, folder: str) -> DataFrame:
    months = F.element_at(
        F.array(*[F.lit(m) for m in SHIFTS]),
        F.least(F.floor((F.dayofmonth("ts") - 1) / 5) + 1, F.lit(len(SHIFTS))).cast("int"),
    )
    return table(spark, folder, "events").withColumn("ts", F.col("ts") - F.make_ym_interval(F.lit(0), months))


def study_trips(spark: SparkSession, folder: str) -> DataFrame:
    """The same trips spread over the study's months, between zones around the origin."""
    return _trips(
        shifted_events(spark, folder),
        F.col("ts"),
        238 + F.col("user_id") % 2,
        237 + F.col("event_id") % 3,
    )


def modes(all_trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Taxis and bikes, four common columns each."""
    columns = ["pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID"]
    return tuple(all_trips.filter(F.col("mode") == m).select(*columns) for m in ("taxis", "bikes"))


def _weather(events: DataFrame) -> DataFrame:
    """Hourly weather with the raw file's columns; every fifth hour is missing."""
    whole = F.floor(F.col("value"))

    def count_of(kind: str):
        return F.count_if(F.col("event_type") == kind).cast("double")

    return (
        events.filter(F.hour("ts") % 5 != 0)
        .groupBy(F.to_date("ts").alias("Date"), F.hour("ts").alias("Time bin"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("Temperature"),
            count_of("view").alias("Dew Point"),
            count_of("click").alias("Humidity"),
            F.sum(whole).cast("double").alias("Wind Speed"),
            F.max(whole).cast("double").alias("Wind Gust"),
            F.min(whole).cast("double").alias("Pressure"),
            count_of("error").alias("Precipitation"),
            F.lit("Fair").alias("Condition"),
        )
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    return _weather(table(spark, folder, "events"))


def study_weather(spark: SparkSession, folder: str) -> DataFrame:
    return _weather(shifted_events(spark, folder))


def raw_taxis(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as raw taxi trips, with codes out of range and missing drop-offs."""
    start = F.timestamp_add("HOUR", (F.col("l_orderkey") % 24).cast("int"), F.col("l_shipdate"))
    missing = (F.col("l_linenumber") == 3) & (F.col("l_tax") == 0)
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("ride"),
        (F.col("l_linenumber") % 4).alias("VendorID"),
        F.col("l_linenumber").alias("payment_type"),
        (F.col("l_suppkey") % 7).cast("int").alias("RatecodeID"),
        (F.col("l_partkey") % 3).cast("int").alias("trip_type"),
        (F.col("l_quantity") % 7).alias("passenger_count"),
        (F.col("l_quantity") * 0.6).alias("trip_distance"),
        (F.col("l_partkey") % 30).cast("int").alias("PULocationID"),
        (F.col("l_suppkey") % 30).cast("int").alias("DOLocationID"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("shared_match_flag"),
        F.when(F.col("l_linestatus") == "F", "Y").otherwise("N").alias("wav_match_flag"),
        start.alias("pickup_datetime"),
        F.when(
            ~missing, F.timestamp_add("SECOND", F.floor(F.col("l_extendedprice") / 20).cast("int"), start)
        ).alias("dropoff_datetime"),
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as stations: every seventh was not renamed, every fifth zone is unknown."""
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        key.cast("int").alias("id"),
        F.col("s_name").alias("name"),
        F.when(key % 5 != 0, F.col("s_nationkey")).alias("Taxi area code"),
        F.when(key % 7 != 0, F.concat(F.lit("SYS"), key.cast("string"))).alias("new_id"),
    )


def rides(spark: SparkSession, folder: str) -> DataFrame:
    """Events as bike rides with station attributes; a station's name depends on the event
    type, so the earliest sighting matters."""

    def end(station, prefix: str) -> list:
        return [
            station.alias(f"{prefix} station id"),
            F.concat(F.lit("Station "), station.cast("string"), F.lit(" "), F.col("event_type")).alias(
                f"{prefix} station name"
            ),
            (station * 37 % 101 / F.lit(64.0) + 0.003).alias(f"{prefix} station latitude"),
            (station * 53 % 103 / F.lit(64.0) + 0.005).alias(f"{prefix} station longitude"),
        ]

    start, stop = F.col("user_id").cast("int"), (F.col("event_id") % 97).cast("int")
    seconds = F.floor(F.col("value") * 60).cast("int")
    return table(spark, folder, "events").select(
        F.col("ts").alias("starttime"),
        F.timestamp_add("SECOND", seconds, F.col("ts")).alias("stoptime"),
        *end(start, "start"),
        *end(stop, "end"),
    )


RIDE_START = [f"start station {c}" for c in ("id", "name", "latitude", "longitude")]
RIDE_END = [f"end station {c}" for c in ("id", "name", "latitude", "longitude")]

ZONE_SIDE = 0.4


def zone_rings(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as zones: diamonds on a five by five grid that overlap their neighbours."""
    key = F.col("n_nationkey")
    cx, cy = (key % 5) * ZONE_SIDE, F.floor(key / 5) * ZONE_SIDE

    def point(dx: float, dy: float):
        return F.struct((cx + dx).alias("x"), (cy + dy).alias("y"))

    half = 0.3125
    ring = F.array(point(-half, 0), point(0, half), point(half, 0), point(0, -half))
    return table(spark, folder, "nation").select(key.alias("zone_id"), ring.alias("ring"))


# ---- the same inputs in SQL ----

_EVENT_TRIP = """
SELECT event_id,
       CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'taxis' ELSE 'bikes' END AS mode,
       ts AS pickup_datetime,
       ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS dropoff_datetime,
       CAST({origin} AS INTEGER) AS PULocationID,
       CAST({destination} AS INTEGER) AS DOLocationID
FROM {events}"""

_FEATURES = """
SELECT *,
       CAST(year(pickup_datetime) AS INTEGER) AS year,
       CAST(month(pickup_datetime) AS INTEGER) AS month,
       CAST(dayofyear(pickup_datetime) AS INTEGER) AS day,
       CAST(hour(pickup_datetime) AS INTEGER) AS time_bin,
       CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week,
       date_diff('second', pickup_datetime, dropoff_datetime) AS trip_duration
FROM trips"""

_WEATHER = """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(dayofyear(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS time_bin,
       CAST(count(*) AS DOUBLE) AS "Temperature",
       CAST(count(*) FILTER (event_type = 'view') AS DOUBLE) AS "Dew Point",
       CAST(count(*) FILTER (event_type = 'click') AS DOUBLE) AS "Humidity",
       CAST(sum(floor(value)) AS DOUBLE) AS "Wind Speed",
       CAST(max(floor(value)) AS DOUBLE) AS "Wind Gust",
       CAST(min(floor(value)) AS DOUBLE) AS "Pressure",
       CAST(count(*) FILTER (event_type = 'error') AS DOUBLE) AS "Precipitation"
FROM {events} WHERE hour(ts) % 5 <> 0 GROUP BY 1, 2, 3, 4"""

_SHIFTED = """
SELECT * REPLACE (ts - to_months(CAST([42, 34, 31, 27, 23, 21][least((day(ts) - 1) // 5 + 1, 6)] AS INTEGER)) AS ts)
FROM events"""


def with_trips(query: str, study: bool = False) -> str:
    """CTEs ``trips``, ``feat`` (calendar added), ``weather``, ``taxis`` and ``bikes``."""
    if study:
        start = f"WITH shifted AS ({_SHIFTED}), trips AS (" + _EVENT_TRIP.format(
            origin="238 + user_id % 2", destination="237 + event_id % 3", events="shifted"
        )
        source = "shifted"
    else:
        start = "WITH trips AS (" + _EVENT_TRIP.format(
            origin="user_id % 2", destination="event_id % 2", events="events"
        )
        source = "events"
    return (
        f"{start}), feat AS ({_FEATURES}), weather AS ({_WEATHER.format(events=source)}), "
        "kept AS (SELECT * FROM feat WHERE day_of_week BETWEEN 2 AND 6 "
        "AND trip_duration > 0 AND trip_duration < 10800), "
        "taxis AS (SELECT * FROM kept WHERE mode = 'taxis'), "
        "bikes AS (SELECT * FROM kept WHERE mode = 'bikes') " + query
    )


RAW_TAXIS_SQL = """
WITH starts AS (
  SELECT *, l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS started FROM lineitem
), raw AS (
  SELECT l_orderkey AS ride, CAST(l_linenumber % 4 AS INTEGER) AS VendorID,
         l_linenumber AS payment_type, CAST(l_suppkey % 7 AS INTEGER) AS RatecodeID,
         CAST(l_partkey % 3 AS INTEGER) AS trip_type, l_quantity % 7 AS passenger_count,
         l_quantity * CAST(0.6 AS DOUBLE) AS trip_distance, CAST(l_partkey % 30 AS INTEGER) AS PULocationID,
         CAST(l_suppkey % 30 AS INTEGER) AS DOLocationID,
         CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS shared_match_flag,
         CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS wav_match_flag,
         started AS pickup_datetime,
         CASE WHEN NOT (l_linenumber = 3 AND l_tax = 0) THEN
           started + to_seconds(CAST(floor(l_extendedprice / 20) AS BIGINT)) END AS dropoff_datetime
  FROM starts
), stations AS (
  SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS name,
         CASE WHEN s_suppkey % 5 <> 0 THEN s_nationkey END AS zone,
         CASE WHEN s_suppkey % 7 <> 0 THEN 'SYS' || s_suppkey END AS new_id
  FROM supplier
) """

RIDES_SQL = """
WITH rides AS (
  SELECT event_id, event_type, ts AS starttime,
         ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS stoptime,
         CAST(user_id AS INTEGER) AS start_id, CAST(event_id % 97 AS INTEGER) AS end_id
  FROM events
), sightings AS (
  SELECT start_id AS id, event_type, starttime, 0 AS side FROM rides
  UNION ALL SELECT end_id, event_type, starttime, 1 FROM rides
), station_dim AS (
  SELECT id, name, latitude, longtitude FROM (
    SELECT id, 'Station ' || id || ' ' || event_type AS name,
           id * 37 % 101 / CAST(64 AS DOUBLE) + CAST(0.003 AS DOUBLE) AS latitude,
           id * 53 % 103 / CAST(64 AS DOUBLE) + CAST(0.005 AS DOUBLE) AS longtitude,
           row_number() OVER (PARTITION BY id ORDER BY starttime, side,
                              'Station ' || id || ' ' || event_type) AS place
    FROM sightings) WHERE place = 1
) """

ZONES_SQL = """zones AS (
  SELECT n_nationkey AS zone_id, (n_nationkey % 5) * CAST(0.4 AS DOUBLE) AS cx,
         (n_nationkey // 5) * CAST(0.4 AS DOUBLE) AS cy FROM nation
) """

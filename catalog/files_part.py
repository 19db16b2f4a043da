"""Queries on the whole run over files: raw months, curated months, processed tables."""

from functools import reduce

from pyspark.sql import functions as F

from catalog import inputs
from catalog.trips_part import _fresh_path, _wall_clock, query
from wayfare.operators.columns import tagged
from wayfare.plans import process
from wayfare.sources import feeds, publish, schemas, sinks

# Station id, zone and new id; the first station's zone is not known.
STATION_ROWS = [(0, None, "SYS0"), (1, 238, "3.10"), (2, 239, "SYS2")]

# The months that the moved events fall into.
EVENT_MONTHS = [(2020, 7), (2021, 3), (2021, 6), (2021, 10), (2022, 2), (2022, 4)]


def _raw_events(spark, folder):
    events = inputs.shifted_events(spark, folder)
    seconds = F.floor(F.col("value") * 60).cast("int")
    return events.withColumns(
        {
            "start": F.col("ts"),
            "end": F.timestamp_add("SECOND", seconds, F.col("ts")),
            "PULocationID": (238 + F.col("user_id") % 2).cast("long"),
            "DOLocationID": (237 + F.col("event_id") % 3).cast("long"),
        }
    )


def _street(events, prefix: str, late: bool):
    """A street taxi file; later ones have other types and one more column."""
    kind = "double" if late else "long"
    columns = [
        F.col("start").alias(f"{prefix}pep_pickup_datetime"),
        F.col("end").alias(f"{prefix}pep_dropoff_datetime"),
        (F.col("event_id") % 4).alias("VendorID"),
        (F.col("event_id") % 7 + 1).alias("payment_type"),
        (F.col("event_id") % 6 + 1).cast(kind).alias("RatecodeID"),
        (F.col("user_id") % 6).cast(kind).alias("passenger_count"),
        (F.col("event_id") % 30).cast("double").alias("trip_distance"),
        "PULocationID",
        "DOLocationID",
    ]
    trip_type = [(F.col("event_id") % 3).cast("double").alias("trip_type")] if prefix == "l" else []
    return events.select(*columns, *trip_type, *([F.lit(0.0).alias("airport_fee")] if late else []))


def _for_hire(events):
    def flag(kept):
        return F.when(kept, "N").otherwise("Y")

    return events.select(
        F.col("start").alias("pickup_datetime"),
        F.col("end").alias("dropoff_datetime"),
        (F.col("event_id") % 30).cast("double").alias("trip_miles"),
        "PULocationID",
        "DOLocationID",
        flag(F.col("event_id") % 3 != 0).alias("shared_match_flag"),
        flag(F.col("user_id") % 4 != 0).alias("wav_match_flag"),
    )


def _bikes(events, old: bool):
    """A bike file as text; some clocks and years of birth are broken."""
    known = F.array(*[F.lit(new) for _, _, new in STATION_ROWS], F.lit("SYS9"))

    def station(key):
        return (key % 4).cast("string") if old else F.get(known, (key % 4).cast("int"))

    def clock(moment):
        return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")

    own = {
        "starttime" if old else "started_at": F.when(F.col("event_id") % 11 == 0, "soon").otherwise(clock(F.col("start"))),
        "stoptime" if old else "ended_at": clock(F.col("end")),
        "start station id" if old else "start_station_id": station(F.col("user_id")),
        "end station id" if old else "end_station_id": station(F.col("event_id")),
        "birth year": F.when(F.col("event_id") % 5 == 0, "\\N").otherwise("1990"),
    }
    schema = schemas.BIKES_OLD if old else schemas.BIKES_NEW
    return events.select(*[own.get(f.name, F.lit("1")).alias(f.name) for f in schema])


def raw_files(spark, folder) -> str:
    """Every feed's raw month files, from the events, below a new folder."""
    root = _fresh_path(spark, "raw")
    events = _raw_events(spark, folder)
    for year, month in EVENT_MONTHS:
        own = events.filter((F.year("ts") == year) & (F.month("ts") == month))
        kinds = {kind: own.filter(F.col("event_type") == kind) for kind in ("view", "click", "purchase")}
        late, old = year == 2022, (year, month) < feeds.NEW_BIKES_FROM

        def path(code):
            return f"{root}/" + feeds.feed(code).path.format(year=year, month=month)

        sinks.write_table(_street(kinds["view"], "t", late), path("y"))
        sinks.write_table(_street(kinds["click"], "l", late), path("g"))
        sinks.write_table(_for_hire(kinds["purchase"]), path("hv"))
        rides = own.filter(~F.col("event_type").isin(*inputs.TAXI_EVENTS))
        sinks.write_csv(_bikes(rides, old), path("c"))
    named = [(i, f"Station {i}", 40.0, -73.0, zone, new, 40.0, -73.0) for i, zone, new in STATION_ROWS]
    sinks.write_csv(feeds.literal_table(spark, named, schemas.STATIONS), f"{root}/{feeds.feed('b').path}")
    return root


def curated(spark, folder, lost: dict | None = None) -> tuple[str, str]:
    root, target = raw_files(spark, folder), _fresh_path(spark, "curated")
    process.clean_all(spark, root, target, EVENT_MONTHS, lost)
    return root, target


_ZONE = "CASE {0} % 4 WHEN 1 THEN 238 WHEN 2 THEN 239 END"
_CURATED = f"""
WITH shifted AS ({inputs._SHIFTED}), raw AS (
  SELECT *, ts AS pickup_datetime, ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS dropoff_datetime,
    CAST(238 + user_id % 2 AS INTEGER) AS pu, CAST(237 + event_id % 3 AS INTEGER) AS d,
    CAST({_ZONE.format("user_id")} AS INTEGER) AS bike_pu, CAST({_ZONE.format("event_id")} AS INTEGER) AS bike_do
  FROM shifted), street AS (SELECT *, event_id % 4 IN (1, 2) AND event_id % 7 + 1 BETWEEN 1 AND 6
    AND event_id % 6 + 1 IN (1, 4, 5, 6) AND user_id % 6 BETWEEN 1 AND 4 AS coded,
    event_id % 30 BETWEEN 1 AND 24 AND pu <> d AND pu IN (238, 239) AND d IN (238, 239) AS placed FROM raw),
curated AS (
  SELECT 'yellow' AS feed, pickup_datetime, dropoff_datetime, pu AS PULocationID, d AS DOLocationID
  FROM street WHERE event_type = 'view' AND coded AND placed
  UNION ALL SELECT 'green', pickup_datetime, dropoff_datetime, pu, d
  FROM street WHERE event_type = 'click' AND coded AND placed AND event_id % 3 IN (1, 2)
  UNION ALL SELECT 'fhvhv', pickup_datetime, dropoff_datetime, pu, d
  FROM street WHERE event_type = 'purchase' AND placed AND event_id % 3 <> 0 AND user_id % 4 <> 0
  UNION ALL SELECT 'citi', pickup_datetime, dropoff_datetime, bike_pu, bike_do
  FROM street WHERE event_type NOT IN ('view', 'click', 'purchase') AND event_id % 11 <> 0 AND bike_pu <> bike_do)
"""


@query(
    "file_curated",
    _CURATED + "SELECT *, CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month FROM curated",
)
def file_curated(spark, folder):
    """Raw month files of all feeds, of several layouts, cleaned into tables by month and read back."""
    _, target = curated(spark, folder)
    parts = [
        tagged(_wall_clock(publish.read_months(spark, target, name)), "feed", name)
        for name in ("yellow", "green", "fhvhv", "citi")
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "file_lost_values",
    f"""WITH shifted AS ({inputs._SHIFTED}), rides AS (SELECT event_id, ts < TIMESTAMP '2021-02-01' AS old FROM shifted
  WHERE event_type NOT IN ('view', 'click', 'purchase'))
SELECT 'starttime' AS "column", count(*) AS lost FROM rides WHERE old AND event_id % 11 = 0
UNION ALL SELECT 'started_at', count(*) FROM rides WHERE NOT old AND event_id % 11 = 0
UNION ALL SELECT 'birth year', count(*) FROM rides WHERE old AND event_id % 5 = 0""",
)
def file_lost_values(spark, folder):
    """What typed reading could not parse, counted by the cleaning run itself."""
    lost: dict[str, int] = {}
    curated(spark, folder, lost)
    found = [(column, n) for column, n in sorted(lost.items()) if n or column in ("starttime", "started_at", "birth year")]
    return feeds.literal_table(spark, found, "column string, lost long")


@query(
    "file_rejects",
    f"""WITH shifted AS ({inputs._SHIFTED}), rides AS (SELECT event_id FROM shifted
  WHERE event_type NOT IN ('view', 'click', 'purchase') AND ts < TIMESTAMP '2021-02-01')
SELECT 'starttime' AS "column", 'soon' AS value, count(*) AS rows FROM rides WHERE event_id % 11 = 0 HAVING count(*) > 0
UNION ALL SELECT 'birth year', '\\N', count(*) FROM rides WHERE event_id % 5 = 0 HAVING count(*) > 0""",
)
def file_rejects(spark, folder):
    """The values themselves, from the text files of the old layout."""
    root = raw_files(spark, folder)
    old = [f"{root}/" + feeds.feed("c").path.format(year=y, month=m) for y, m in EVENT_MONTHS if (y, m) < feeds.NEW_BIKES_FROM]
    rejected = feeds.rejected_values(feeds.read_csv(spark, old), schemas.BIKES_OLD)
    return rejected.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "file_counts",
    _CURATED
    + """, timed AS (SELECT *, CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
  CAST(dayofyear(pickup_datetime) AS INTEGER) AS day, CAST(hour(pickup_datetime) AS INTEGER) AS time_bin,
  CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week,
  date_diff('second', pickup_datetime, dropoff_datetime) AS seconds FROM curated)
SELECT year, month, day, time_bin, PULocationID, DOLocationID, day_of_week,
  CASE WHEN seconds > 0 AND seconds < 10800 THEN seconds END AS trip_duration,
  count(*) FILTER (feed <> 'citi') AS n_taxis, count(*) FILTER (feed = 'citi') AS n_bikes
FROM timed WHERE day_of_week BETWEEN 2 AND 6 GROUP BY ALL""",
)
def file_counts(spark, folder):
    """The whole run up to the table that pairing starts from, read back from its files."""
    root, target = curated(spark, folder)
    out = _fresh_path(spark, "processed")
    process.process_all(spark, root, target, out)
    return sinks.read_table(spark, f"{out}/counts")


@query(
    "file_republished",
    _CURATED
    + """SELECT *, CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month
FROM curated WHERE feed = 'citi' AND NOT (year(pickup_datetime) = 2021 AND month(pickup_datetime) = 3)""",
)
def file_republished(spark, folder):
    """A second release empties one month of one feed; a third dies before it is shown."""
    _, target = curated(spark, folder)
    trips = publish.read_months(spark, target, "citi").withColumnsRenamed({"year": "file_year", "month": "file_month"})
    second = publish.Release(spark, target)
    second.write_months(trips.filter("false"), "citi", [(2021, 3)])
    second.commit()
    third = publish.Release(spark, target)
    third.write_months(trips.filter("file_year = 2021 AND file_month = 6"), "citi", [(2020, 7), (2021, 6)])
    return tagged(_wall_clock(publish.read_months(spark, target, "citi")), "feed", "citi")

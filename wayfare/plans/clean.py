"""Cleaning: each feed to the common four-column trip shape."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators import filters
from wayfare.operators.sides import bounded_side
from wayfare.sources.feeds import trip_shape

ZONE_COLUMN = "Taxi area code"


def bike_zones(stations: DataFrame) -> DataFrame:
    """Distinct zones that have a bike station, as a join side."""
    return bounded_side(stations.select(F.col(ZONE_COLUMN).alias("zone")).na.drop().distinct())


def in_bike_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips that start and end in a zone of the dimension."""
    started = filters.in_dimension(trips, zones, "PULocationID", "zone")
    return filters.in_dimension(started, zones, "DOLocationID", "zone")


def street_taxi_rules(rate_codes=filters.RATE_CODES) -> list[filters.Rule]:
    return [
        *filters.code_rules(rate_codes),
        filters.passenger_rule(),
        filters.distance_rule(),
        filters.different_zones_rule(),
    ]


def green_rules(rate_codes=filters.RATE_CODES) -> list[filters.Rule]:
    return [*street_taxi_rules(rate_codes), filters.trip_type_rule()]


def for_hire_rules() -> list[filters.Rule]:
    return [
        filters.distance_rule(),
        filters.different_zones_rule(),
        *filters.private_ride_rules(),
    ]


def _clean(trips: DataFrame, zones: DataFrame, rules: list[filters.Rule]) -> DataFrame:
    return trip_shape(in_bike_zones(filters.keep(trips, *rules), zones)).na.drop()


def clean_yellow(trips: DataFrame, zones: DataFrame, rate_codes=filters.RATE_CODES) -> DataFrame:
    return _clean(trips, zones, street_taxi_rules(rate_codes))


def clean_green(trips: DataFrame, zones: DataFrame, rate_codes=filters.RATE_CODES) -> DataFrame:
    return _clean(trips, zones, green_rules(rate_codes))


def clean_for_hire(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return _clean(trips, zones, for_hire_rules())


# Per layout, the station id column at both ends, the two clocks and the
# dimension's matching id.
BIKE_LAYOUTS = {
    "old": ("start station id", "end station id", "starttime", "stoptime", "id"),
    "new": ("start_station_id", "end_station_id", "started_at", "ended_at", "new_id"),
}


def station_zone_side(stations: DataFrame, layout: str) -> DataFrame:
    """Station id to zone, one row per id.

    Two old stations can have been matched to one new id; the lowest old id decides then,
    so that the join cannot multiply trips.
    """
    key = BIKE_LAYOUTS[layout][-1]
    return bounded_side(
        stations.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).cast("string").alias("station"))
        .agg(F.min_by(F.col(f"`{ZONE_COLUMN}`"), "id").alias("zone"))
    )


def with_station_zones(rides: DataFrame, side: DataFrame, layout: str) -> DataFrame:
    """Rides between known stations with the zones of both ends.

    Station ids are compared as text: new ids such as ``SYS...`` or ``3.10`` are not numbers.
    """
    start, end = BIKE_LAYOUTS[layout][:2]

    def attach(df: DataFrame, column: str, zone: str) -> DataFrame:
        known = side.select(F.col("station").alias("_station"), F.col("zone").alias(zone))
        return df.join(known, F.col(f"`{column}`").cast("string") == F.col("_station")).drop(
            "_station"
        )

    return attach(attach(rides, start, "PULocationID"), end, "DOLocationID")


def clean_bikes(rides: DataFrame, stations: DataFrame, layout: str) -> DataFrame:
    start_clock, end_clock = BIKE_LAYOUTS[layout][2:4]
    zoned = with_station_zones(rides, station_zone_side(stations, layout), layout)
    different = filters.keep(zoned, filters.different_zones_rule())
    return trip_shape(different, pickup_datetime=start_clock, dropoff_datetime=end_clock).na.drop()

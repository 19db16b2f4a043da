"""Declared schemas of the text inputs and the common trip shape.

Column names are fixed values: they are the headers of the published files.
"""

from pyspark.sql import types as T


def _fields(**kinds: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind) for name, kind in kinds.items()]


TRIP_COLUMNS = ["pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID"]

BIKES_OLD = T.StructType(
    [
        T.StructField("tripduration", T.IntegerType()),
        T.StructField("starttime", T.TimestampType()),
        T.StructField("stoptime", T.TimestampType()),
        T.StructField("start station id", T.IntegerType()),
        T.StructField("start station name", T.StringType()),
        T.StructField("start station latitude", T.DoubleType()),
        T.StructField("start station longitude", T.DoubleType()),
        T.StructField("end station id", T.IntegerType()),
        T.StructField("end station name", T.StringType()),
        T.StructField("end station latitude", T.DoubleType()),
        T.StructField("end station longitude", T.DoubleType()),
        T.StructField("bikeid", T.IntegerType()),
        T.StructField("usertype", T.StringType()),
        T.StructField("birth year", T.IntegerType()),
        T.StructField("gender", T.IntegerType()),
    ]
)

BIKES_NEW = T.StructType(
    _fields(
        ride_id=T.StringType(),
        rideable_type=T.StringType(),
        started_at=T.TimestampType(),
        ended_at=T.TimestampType(),
        start_station_name=T.StringType(),
        start_station_id=T.StringType(),
        end_station_name=T.StringType(),
        end_station_id=T.StringType(),
        start_lat=T.DoubleType(),
        start_lng=T.DoubleType(),
        end_lat=T.DoubleType(),
        end_lng=T.DoubleType(),
        member_casual=T.StringType(),
    )
)

STATIONS = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longtitude", T.DoubleType()),
        T.StructField("Taxi area code", T.IntegerType()),
        T.StructField("new_id", T.StringType()),
        T.StructField("new_latitude", T.DoubleType()),
        T.StructField("new_longtitude", T.DoubleType()),
    ]
)

WEATHER_MEASURES = [
    "Temperature",
    "Dew Point",
    "Humidity",
    "Wind Speed",
    "Wind Gust",
    "Pressure",
    "Precipitation",
]

WEATHER = T.StructType(
    [
        T.StructField("Date", T.DateType()),
        T.StructField("Time bin", T.IntegerType()),
        *[T.StructField(name, T.DoubleType()) for name in WEATHER_MEASURES],
        T.StructField("Condition", T.StringType()),
    ]
)

ZONE_LOOKUP = T.StructType(_fields(LocationID=T.IntegerType(), Borough=T.StringType()))

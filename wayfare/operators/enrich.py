"""Per-hour traffic counts and hourly weather."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.calendar import HOUR_KEYS
from wayfare.operators.sides import bounded_side, require_unique


def hourly_counts(trips: DataFrame, name: str = "count") -> DataFrame:
    return trips.groupBy(*HOUR_KEYS).agg(F.count(F.lit(1)).alias(name))


def with_traffic(trips: DataFrame, name: str = "count") -> DataFrame:
    """Adds the number of trips that started in the same hour.

    A window over the hour would send all trips of a busy hour to one task. Here the hours
    are counted with partial aggregation and the small result is joined back, so the trips
    themselves are not shuffled.
    """
    return trips.join(bounded_side(hourly_counts(trips, name)), HOUR_KEYS, "left")


def prepare_weather(raw: DataFrame) -> DataFrame:
    """Hour keys from the date; the text condition is dropped, the date column stays."""
    return (
        raw.withColumnRenamed("Time bin", "time_bin")
        .withColumns({"year": F.year("Date"), "month": F.month("Date"), "day": F.dayofyear("Date")})
        .drop("Condition")
    )


def weather_side(weather: DataFrame) -> DataFrame:
    """The weather as a join side: one row per hour (checked), broadcast if it fits."""
    return require_unique(bounded_side(weather), HOUR_KEYS)


def with_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join; trips of an hour without weather keep null measures.

    ``weather`` is the result of :func:`weather_side`, so that several modes share one.
    """
    return trips.join(weather, HOUR_KEYS, "left")

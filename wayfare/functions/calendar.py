"""Clock and calendar expressions over trip timestamps."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names by dayofweek code.
WEEKDAY_NAMES = {
    1: "Sunday",
    2: "Monday",
    3: "Tuesday",
    4: "Wednesday",
    5: "Thursday",
    6: "Friday",
    7: "Saturday",
}

HOUR_KEYS = ["year", "month", "day", "time_bin"]


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Difference of the two clocks' whole seconds (each is floored first)."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def minutes(seconds: Column) -> Column:
    return seconds / F.lit(60)


def hour_key_columns(moment: Column) -> dict[str, Column]:
    return {
        "year": F.year(moment),
        "month": F.month(moment),
        "day": F.dayofyear(moment),
        "time_bin": F.hour(moment),
    }


def with_calendar(
    trips: DataFrame,
    duration: str = "trip_duration",
    start: str = "pickup_datetime",
    end: str = "dropoff_datetime",
) -> DataFrame:
    """Adds year, month, day of year, hour, weekday code and the trip's duration in seconds."""
    return trips.withColumns(
        {
            **hour_key_columns(F.col(start)),
            "day_of_week": F.dayofweek(F.col(start)),
            duration: elapsed_seconds(F.col(start), F.col(end)),
        }
    )


def weekday_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(part) for item in WEEKDAY_NAMES.items() for part in item])
    return F.element_at(names, code)

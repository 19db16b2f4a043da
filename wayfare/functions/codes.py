"""Category codes computed from the calendar and from paired durations.

A null input gives a null code.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Half-open hour bands that count as peak, and the day-of-year season edges.
PEAK_BANDS = ((8, 11), (16, 19))
COLD_BEFORE, HOT_FROM, HOT_BEFORE, COLD_FROM = 60, 150, 240, 330
COLD, HOT, WARM = 0, 1, 2


def in_band(value: Column, low: int, high: int) -> Column:
    return (value >= low) & (value < high)


def peak_code(hour: Column) -> Column:
    inside = F.lit(False)
    for low, high in PEAK_BANDS:
        inside = inside | in_band(hour, low, high)
    return F.when(hour.isNotNull(), inside.cast("int"))


def season_code(day_of_year: Column) -> Column:
    cold = (day_of_year < COLD_BEFORE) | (day_of_year >= COLD_FROM)
    return (
        F.when(cold, COLD)
        .when(in_band(day_of_year, HOT_FROM, HOT_BEFORE), HOT)
        .when(day_of_year.isNotNull(), WARM)
    )


def better_mode_code(difference: Column) -> Column:
    """1 where the taxi took longer than the bike; ties go to 0."""
    return (difference > 0).cast("int")


def hour_codes() -> dict[str, Column]:
    """Peak and season columns, which follow from the hour alone."""
    return {"peak_hours": peak_code(F.col("time_bin")), "weather_pattern": season_code(F.col("day"))}


def difference_codes() -> dict[str, Column]:
    """Difference and better-mode columns, which follow from the two durations alone."""
    difference = F.col("trip_duration_taxis") - F.col("trip_duration_bikes")
    return {"trip_difference": difference, "better_travel_type": better_mode_code(difference)}


def with_pair_codes(pairs: DataFrame) -> DataFrame:
    """Difference, peak, season and better-mode columns of paired trips."""
    codes = difference_codes() | hour_codes()
    return pairs.withColumns(
        {c: codes[c] for c in ("trip_difference", "peak_hours", "weather_pattern", "better_travel_type")}
    )

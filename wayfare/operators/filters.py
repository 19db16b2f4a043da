"""Row rules.

A rule is a name with a predicate. Cleaning keeps the rows for which every predicate is
true; the rule report counts survivors with the same list. A null predicate drops the row.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]

# Accepted codes and limits of the study.
VENDORS = (1, 2)
PAYMENT_TYPES = (1, 2, 3, 4, 5, 6)
RATE_CODES = (1, 4, 5, 6)
TRIP_TYPES = (1, 2)
PASSENGER_LIMITS = (0, 5)
DISTANCE_LIMITS = (0, 25)
MAX_SECONDS = 10800
WEEKDAYS = (2, 6)


def between_open(value: Column, low: float, high: float) -> Column:
    return (value > low) & (value < high)


def code_rules(rate_codes=RATE_CODES) -> list[Rule]:
    return [
        ("vendor", F.col("VendorID").isin(*VENDORS)),
        ("payment", F.col("payment_type").isin(*PAYMENT_TYPES)),
        ("rate_code", F.col("RatecodeID").isin(*rate_codes)),
    ]


def trip_type_rule() -> Rule:
    return ("trip_type", F.col("trip_type").isin(*TRIP_TYPES))


def passenger_rule(column: str = "passenger_count") -> Rule:
    return ("passengers", between_open(F.col(column), *PASSENGER_LIMITS))


def distance_rule(column: str = "trip_distance") -> Rule:
    return ("distance", between_open(F.col(column), *DISTANCE_LIMITS))


def different_zones_rule() -> Rule:
    return ("different_zones", F.col("PULocationID") != F.col("DOLocationID"))


def private_ride_rules() -> list[Rule]:
    return [
        ("not_shared", F.col("shared_match_flag") == "N"),
        ("not_wheelchair", F.col("wav_match_flag") == "N"),
    ]


def weekday_rule(column: str = "day_of_week") -> Rule:
    return ("weekday", F.col(column).between(*WEEKDAYS))


def duration_rule(column: str, max_seconds: int = MAX_SECONDS, positive: bool = True) -> Rule:
    """``positive=False`` keeps zero and negative durations, as the per-mode tables do."""
    value = F.col(column)
    inside = value < max_seconds
    return ("duration_" + column, (value > 0) & inside if positive else inside)


def origin_band_rule(origin: int, low: int, high: int) -> Rule:
    hour = F.col("time_bin")
    return ("origin_band", (F.col("PULocationID") == origin) & (hour >= low) & (hour < high))


def keep(df: DataFrame, *rules: Rule) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [predicate for _, predicate in rules]))


def drop_null_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=columns)


def rows_with_nulls(df: DataFrame) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in df.columns]))


def in_dimension(df: DataFrame, dimension: DataFrame, column: str, key: str) -> DataFrame:
    """Rows whose ``column`` occurs in the dimension's ``key`` (a left semi join)."""
    known = dimension.select(F.col(f"`{key}`").alias(column))
    return df.join(known, column, "left_semi")


def starts_with(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.startswith(F.col(column), F.lit(prefix)))


def log_below(df: DataFrame, column: str, bound: float) -> DataFrame:
    return df.filter(F.log(F.col(column)) < bound)

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wayfare.functions import calendar, codes


def _one(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(
    "hour, code",
    [(7, 0), (8, 1), (10, 1), (11, 0), (15, 0), (16, 1), (18, 1), (19, 0), (None, None)],
)
def test_peak_edges(spark, hour, code):
    assert _one(spark, [(hour,)], "h int", codes.peak_code(F.col("h"))) == [code]


@pytest.mark.parametrize(
    "day, code",
    [(1, 0), (59, 0), (60, 2), (149, 2), (150, 1), (239, 1), (240, 2), (329, 2), (330, 0), (366, 0), (None, None)],
)
def test_season_edges(spark, day, code):
    assert _one(spark, [(day,)], "d int", codes.season_code(F.col("d"))) == [code]


@pytest.mark.parametrize("difference, code", [(1, 1), (0, 0), (-1, 0), (None, None)])
def test_better_mode_ties_go_to_zero(spark, difference, code):
    assert _one(spark, [(difference,)], "x long", codes.better_mode_code(F.col("x"))) == [code]


def test_seconds_are_floored_before_the_difference(spark):
    start, end = datetime(2021, 1, 1, 0, 0, 0, 900000), datetime(2021, 1, 1, 0, 0, 2, 100000)
    for kind in ("timestamp", "timestamp_ntz"):
        seconds = calendar.elapsed_seconds(F.col("a"), F.col("b"))
        assert _one(spark, [(start, end)], f"a {kind}, b {kind}", seconds) == [2]
        assert _one(spark, [(end, start)], f"a {kind}, b {kind}", seconds) == [-2]


def test_calendar_of_a_leap_year_end(spark):
    rows = [(datetime(2020, 12, 31, 23, 59, 59), datetime(2021, 1, 1, 0, 0, 5))]
    trips = spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz")
    row = calendar.with_calendar(trips).first()
    assert (row["year"], row["month"], row["day"], row["time_bin"]) == (2020, 12, 366, 23)
    assert (row["day_of_week"], row["trip_duration"]) == (5, 6)


def test_weekday_names_cover_the_week(spark):
    names = _one(spark, [(i,) for i in range(1, 8)], "d int", calendar.weekday_name(F.col("d")))
    assert names == ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def test_pair_codes(spark):
    rows = [(8, 100, 300, 200), (11, 200, 100, 100)]
    pairs = spark.createDataFrame(
        rows, "time_bin int, day int, trip_duration_taxis long, trip_duration_bikes long"
    )
    got = codes.with_pair_codes(pairs).select(
        "trip_difference", "peak_hours", "weather_pattern", "better_travel_type"
    )
    assert sorted(map(tuple, got.collect())) == [(0, 0, 1, 0), (100, 1, 2, 1)]

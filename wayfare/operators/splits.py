"""Splits by time."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Validation starts after this month of the validation year.
VALIDATION_YEAR, TEST_YEAR, LAST_TRAIN_MONTH = 2021, 2022, 8


def _is_validation(validation_year: int, last_month: int) -> Column:
    return (F.col("year") == validation_year) & (F.col("month") > last_month)


def three_way_split(
    df: DataFrame,
    validation_year: int = VALIDATION_YEAR,
    test_year: int = TEST_YEAR,
    last_month: int = LAST_TRAIN_MONTH,
) -> DataFrame:
    """Train: the year before, and the validation year up to ``last_month``. Other years: null."""
    year, month = F.col("year"), F.col("month")
    early = (year == validation_year) & (month <= last_month)
    return df.withColumn(
        "split",
        F.when(year == test_year, "test")
        .when(_is_validation(validation_year, last_month), "validation")
        .when((year == validation_year - 1) | early, "train"),
    )


def two_way_split(
    df: DataFrame, validation_year: int = VALIDATION_YEAR, last_month: int = LAST_TRAIN_MONTH
) -> DataFrame:
    """As above without a test year; early months of any year count as train."""
    year, month = F.col("year"), F.col("month")
    return df.withColumn(
        "split",
        F.when(_is_validation(validation_year, last_month), "validation").when(
            (year == validation_year - 1) | (month <= last_month), "train"
        ),
    )

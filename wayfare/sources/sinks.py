"""Writers. All overwrite; monthly tables overwrite only the months they contain.

Table writers return the number of rows. It is observed by the job that writes, so that no
second pass over the input is needed to report it.
"""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _observed(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, *[value.alias(name) for name, value in counts.items()]), seen


def write_months(
    trips: DataFrame, path: str, months: list[tuple[int, int]], compact: bool = False
) -> int:
    """Partitioned by year and month of the file a trip came from; replaces exactly ``months``.

    Files hold some trips dated in a neighbouring month. Those stay with their file, so writing
    one month again never touches another, and a month that became empty is emptied.
    ``trips`` has the columns ``file_year`` and ``file_month``; a trip of a month that is not
    named is an error, as its old rows would be lost. A feed arrives by month, so each task
    already holds one or two months. ``compact`` rebalances first (AQE then splits a month that
    holds much of the data over many tasks).
    """
    keyed = _month_keyed(trips, months)
    if compact:
        keyed = keyed.hint("rebalance", "year", "month")
    counted, seen = _observed(keyed, rows=F.count(F.lit(1)), **_month_counts(months))
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )
    for year, month in months:
        if not seen.get[f"n{year}_{month}"]:  # keeps no earlier rows
            _delete(trips.sparkSession, f"{path}/year={year}/month={month}")
    return seen.get["rows"]


def _month_keyed(trips: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """``year`` and ``month`` of a trip's file; a month that is not named is an error."""
    named = F.array(*[F.lit(year * 100 + month) for year, month in months])
    own = F.col("file_year") * 100 + F.col("file_month")
    checked = trips.withColumn(
        "file_year",
        F.when(F.array_contains(named, own), F.col("file_year")).otherwise(
            F.raise_error(F.concat(F.lit("trip of a month not named: "), F.coalesce(own.cast("string"), F.lit("null"))))
        ),
    )
    return checked.withColumnsRenamed({"file_year": "year", "file_month": "month"})


def _month_counts(months: list[tuple[int, int]]) -> dict[str, Column]:
    return {
        f"n{year}_{month}": F.count_if((F.col("year") == year) & (F.col("month") == month))
        for year, month in months
    }


def write_new_months(trips: DataFrame, path: str, months: list[tuple[int, int]]) -> dict[tuple[int, int], int]:
    """Writes a new table by month, as :func:`write_months` does; returns the rows of each month."""
    counted, seen = _observed(_month_keyed(trips, months), **_month_counts(months))
    counted.write.partitionBy("year", "month").parquet(path)
    return {(year, month): seen.get[f"n{year}_{month}"] for year, month in months}


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_table(df: DataFrame, path: str) -> int:
    counted, seen = _observed(df, rows=F.count(F.lit(1)))
    counted.write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def with_year_split(df: DataFrame, test_year: int = 2022) -> DataFrame:
    """``split`` is ``test`` for the test year, else ``train``; a null year is in neither."""
    return df.withColumn(
        "split",
        F.when(F.col("year") == test_year, "test").when(F.col("year") != test_year, "train"),
    )


def write_split(df: DataFrame, path: str, test_year: int = 2022) -> dict[str, int]:
    """One pass over the input writes both splits as folders; returns the rows of each."""
    split = F.col("split")
    counted, seen = _observed(
        with_year_split(df, test_year).filter(split.isNotNull()),
        train=F.count_if(split == "train"),
        test=F.count_if(split == "test"),
    )
    counted.write.mode("overwrite").partitionBy("split").parquet(path)
    return dict(seen.get)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

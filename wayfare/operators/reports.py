"""Reports over processed tables. Each returns a small table; nothing is collected here."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.calendar import minutes
from wayfare.models.statistics import exact_quantiles
from wayfare.operators import filters
from wayfare.operators.columns import tagged
from wayfare.operators.compare import pair_means, pair_totals

# The origin zone of the destination reports and the appended constant row.
ORIGIN_ZONE = 239
ORIGIN_SHARE = 1.0


def exact_mean(column: str) -> Column:
    return F.sum(column).cast("double") / F.count(column)


def hourly_profile(trips: DataFrame, duration: str = "trip_duration") -> DataFrame:
    """Mean minutes by hour of day."""
    return trips.groupBy("time_bin").agg(minutes(exact_mean(duration)).alias("avg_minutes"))


def hourly_profiles(taxis: DataFrame, bikes: DataFrame) -> DataFrame:
    """Both modes in long form; ``hue`` is 0 for bikes and 1 for taxis."""
    return tagged(hourly_profile(bikes), "hue", 0).unionByName(
        tagged(hourly_profile(taxis), "hue", 1)
    )


def merged_hourly_profile(sums: DataFrame) -> DataFrame:
    """Mean minutes of both modes by hour, over the pairs of the merged table."""
    return pair_means(sums, "time_bin").select(
        "time_bin",
        minutes(F.col("avg_bikes")).alias("avg_minutes_bikes"),
        minutes(F.col("avg_taxis")).alias("avg_minutes_taxis"),
    )


def daily_counts(trips: DataFrame, year: int) -> DataFrame:
    """Trips per day of one year, in day order, with the logarithm of the count."""
    counts = trips.filter(F.col("year") == year).groupBy("day").agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("log_count", F.log("count")).orderBy("day")


def merged_daily_pairs(sums: DataFrame, test_year: int) -> DataFrame:
    """Pairs per day of year outside the test year, in day order."""
    return pair_totals(sums.filter(F.col("year") != test_year), "day").select("day", "pairs").orderBy("day")


def scaled_by_peak(report: DataFrame, column: str) -> DataFrame:
    """``scaled`` = value over the largest absolute value, by a scalar subquery (null if that is 0)."""
    peak = report.select(F.max(F.abs(F.col(column)))).scalar()
    return report.withColumn("scaled", F.try_divide(F.col(column), peak))


def with_origin_row(report: DataFrame, zone: int = ORIGIN_ZONE) -> DataFrame:
    """The zone/scaled columns plus the origin itself at the constant share."""
    zone_column = report.columns[0]
    origin = report.sparkSession.range(1).select(
        F.lit(zone).cast(report.schema[zone_column].dataType).alias(zone_column),
        F.lit(ORIGIN_SHARE).alias("scaled"),
    )
    return report.unionByName(origin)


def destination_means(trips: DataFrame, origin: int, low: int, high: int, name: str) -> DataFrame:
    banded = filters.keep(trips, filters.origin_band_rule(origin, low, high))
    return banded.groupBy(F.col("DOLocationID").alias("DO_ID")).agg(
        exact_mean("trip_duration").alias(name)
    )


def od_advantage(
    taxis: DataFrame, bikes: DataFrame, low: int, high: int, origin: int = ORIGIN_ZONE
) -> DataFrame:
    """Per destination: mean taxi minus mean bike time from one origin in an hour band."""
    joined = destination_means(taxis, origin, low, high, "avg_time_for_taxis").join(
        destination_means(bikes, origin, low, high, "avg_time_for_bikes"), "DO_ID", "left"
    )
    compared = joined.na.drop().withColumn(
        "difference", F.col("avg_time_for_taxis") - F.col("avg_time_for_bikes")
    )
    return scaled_by_peak(compared, "difference")


def merged_od_advantage(
    sums: DataFrame, zones: DataFrame, low: int, high: int, origin: int = ORIGIN_ZONE
) -> DataFrame:
    """The same over pairs: mean difference per destination, with the zone's attributes."""
    banded = filters.keep(sums, filters.origin_band_rule(origin, low, high))
    means = pair_means(banded, "DOLocationID").select("DOLocationID", "avg_difference")
    named = means.join(zones, F.col("DOLocationID") == F.col("LocationID"))
    return scaled_by_peak(named, "avg_difference")


def zone_attributes(lookup: DataFrame, shapes: DataFrame, borough: str | None = None) -> DataFrame:
    """Zone names joined with their shapes, optionally of one borough."""
    joined = lookup.join(shapes, "LocationID")
    return joined if borough is None else joined.filter(F.col("Borough") == borough)


def first_rows(df: DataFrame, n: int, *order: Column | str, skip: int = 0) -> DataFrame:
    """The first n rows of an explicit order, after skipping some."""
    ordered = df.orderBy(*order)
    return ordered.offset(skip).limit(n) if skip else ordered.limit(n)


def first_per_key(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """One row per key, the first in an explicit order.

    The ``rank = 1`` filter lets Spark drop the other rows of a key before the shuffle, so
    a key that holds much of the data does not land whole in one task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def rule_report(df: DataFrame, rules: list[filters.Rule]) -> DataFrame:
    """Rows in and out of each rule when applied in order, in one pass over the data."""
    passed, measures = F.lit(True), [F.count(F.lit(1)).alias("c0")]
    for i, (_, predicate) in enumerate(rules, start=1):
        passed = passed & F.coalesce(predicate, F.lit(False))
        measures.append(F.count_if(passed).alias(f"c{i}"))
    lines = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"),
                F.lit(name).alias("rule"),
                F.col(f"c{i - 1}").alias("rows_in"),
                F.col(f"c{i}").alias("rows_out"),
            )
            for i, (name, _) in enumerate(rules, start=1)
        ]
    )
    return df.agg(*measures).select(F.inline(lines))


def null_report(df: DataFrame) -> DataFrame:
    """Per column: rows with and without a value, in one pass."""
    names = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"c{i}").alias("non_null"),
                (F.col("n") - F.col(f"c{i}")).alias("nulls"),
            )
            for i, c in enumerate(names)
        ]
    )
    return counted.select(F.inline(lines)).withColumn("any_null", F.col("nulls") > 0)


def summary_report(df: DataFrame, *columns: str) -> DataFrame:
    """One row per numeric column: non-null count, mean, sample deviation, extremes and exact quartiles
    (the smallest value that so many rows do not exceed).

    The figures come from one pass; for the quartiles the distinct values of all columns are counted
    together and searched by range, see :func:`wayfare.models.statistics.exact_quantiles`.
    """
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    chosen = list(columns) or numeric
    figures = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    one = df.agg(
        *[
            figure(F.col(f"`{c}`").cast("double")).alias(f"{name}{i}")
            for i, c in enumerate(chosen)
            for name, figure in figures.items()
        ]
    )
    lines = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"{name}{i}").alias(name) for name in figures])
            for i, c in enumerate(chosen)
        ]
    )
    values = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in chosen]
    )
    counts = df.select(F.inline(values)).na.drop().groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    names = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    quartiles = (
        exact_quantiles(counts, list(names), by=("column",))
        .groupBy("column")
        .agg(*[F.max(F.when(F.col("share") == p, F.col("value"))).alias(n) for p, n in names.items()])
    )
    return one.select(F.inline(lines)).join(F.broadcast(quartiles), "column", "left")


def quality_report(
    raw: DataFrame, rules: list[filters.Rule]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rule report, the null report and the summary of a raw feed."""
    return rule_report(raw, rules), null_report(raw), summary_report(raw)

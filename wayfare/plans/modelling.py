"""The three models from cleaned trips to scored cells.

Each function fits on the training split and returns all cells with a ``prediction``; the
metrics of ``wayfare.models.fits`` then apply per split.
"""

from functools import reduce

from pyspark.ml.regression import GeneralizedLinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.calendar import HOUR_KEYS
from wayfare.functions.codes import peak_code, season_code
from wayfare.models import cells, features, fits, statistics
from wayfare.operators import compare, filters, splits
from wayfare.operators.sides import materialise
from wayfare.sources.schemas import WEATHER_MEASURES

TRAIN = "split = 'train'"


def coded_outcomes(taxis: DataFrame, bikes: DataFrame) -> DataFrame:
    """Outcomes per key with peak and season codes and the time split."""
    return with_codes(compare.key_outcomes(compare.duration_counts(taxis, bikes)))


def stored_outcomes(spark: SparkSession, out: str) -> DataFrame:
    """As :func:`coded_outcomes`, from the tables of a stored run."""
    return with_codes(spark.read.parquet(f"{out}/outcomes"))


def with_codes(outcomes: DataFrame) -> DataFrame:
    coded = outcomes.withColumns(
        {"peak_hours": peak_code(F.col("time_bin")), "weather_pattern": season_code(F.col("day"))}
    )
    return splits.three_way_split(coded)


def class_table(outcomes: DataFrame, weather: DataFrame) -> DataFrame:
    return cells.class_cells(outcomes, weather.drop("Date"), HOUR_KEYS)


def difference_table(outcomes: DataFrame, weather: DataFrame) -> DataFrame:
    return cells.difference_cells(outcomes, weather.drop("Date"), HOUR_KEYS)


def duration_table(trips: DataFrame) -> DataFrame:
    """Cells of one mode's table; the log link needs durations above zero."""
    positive = filters.keep(trips, filters.duration_rule("trip_duration"))
    columns = ["year", *cells.CATEGORIES, "peak_hours", *WEATHER_MEASURES, "count"]
    return splits.three_way_split(cells.label_cells(positive, "trip_duration", columns))


_ZONES = ["PULocationID", "DOLocationID"]
_CALENDAR = ["time_bin", "month", "day_of_week", "weather_pattern"]
_COMPONENTS = ["pca_a", "pca_b"]

# The study's significance models of each mode, as power of the duration and terms.
BIKE_ANOVAS = {
    "weather, plain": (1.0, WEATHER_MEASURES),
    "weather": (0.2, WEATHER_MEASURES),
    "zones, weather, log_count": (0.2, [*_ZONES, *WEATHER_MEASURES, "log_count"]),
    "zones, weather, count": (0.2, [*_ZONES, *WEATHER_MEASURES, "count"]),
    "zones, weather, count, components": (0.2, [*_ZONES, *WEATHER_MEASURES, "count", *_COMPONENTS]),
    "zones, weather, count, calendar": (0.2, [*_ZONES, *WEATHER_MEASURES, "count", *_CALENDAR]),
}
TAXI_ANOVAS = {
    "weather, plain": (1.0, WEATHER_MEASURES),
    "weather": (0.2, WEATHER_MEASURES),
    "fourth root, weather": (0.25, WEATHER_MEASURES),
    "fourth root, weather, count": (0.25, [*WEATHER_MEASURES, "count"]),
    "fourth root, weather, log_count": (0.25, [*WEATHER_MEASURES, "log_count"]),
    "third root, weather, count": (0.33, [*WEATHER_MEASURES, "count"]),
    "third root, zones, count": (0.33, [*_ZONES, "Temperature", "Precipitation", "count"]),
    "third root, calendar, count": (0.33, ["count", "day_of_week", "month", "weather_pattern"]),
}


def study_anovas(trips: DataFrame, models: dict[str, tuple[float, list[str]]]) -> DataFrame:
    """Type-II tables of the models, each a power of the duration on terms of one mode's table.

    Models of one power share one set of cells and sums. `log_count` is the logarithm of the hour's
    trips; `pca_a` and `pca_b` are the scores on the first components of the weather.
    """
    positive = filters.keep(trips, filters.duration_rule("trip_duration")).na.drop()
    if any(set(_COMPONENTS) & set(terms) for _, terms in models.values()):
        positive, _ = statistics.with_components(positive, WEATHER_MEASURES[:6])
    ready = materialise(positive.withColumn("log_count", F.log("count")))
    tables = []
    for power in sorted({power for power, _ in models.values()}):
        own = {name: list(terms) for name, (p, terms) in models.items() if p == power}
        used = sorted({term for terms in own.values() for term in terms})
        levels = [term for term in used if term in (*_ZONES, *_CALENDAR)]
        numbers = [term for term in used if term not in levels]
        label = ready.withColumn("_label", F.pow("trip_duration", F.lit(power))).select("_label", *[f"`{c}`" for c in used])
        table = cells.label_cells(label, "_label", used)
        tables.append(statistics.anova_models(table, own, numbers, levels))
    return reduce(lambda a, b: a.unionByName(b), tables)


def encoded(table: DataFrame, measures: list[str] = WEATHER_MEASURES) -> DataFrame:
    """The table with assembled ``features``, encoder and scales fitted on training rows."""
    kept = materialise(table)
    return materialise(features.fit_encoder(kept, TRAIN, measures=measures).transform(kept))


def scored_classes(outcomes: DataFrame, weather: DataFrame) -> DataFrame:
    table = encoded(class_table(outcomes, weather))
    return fits.fit_classifier(table.filter(TRAIN)).transform(table)


def scored_differences(outcomes: DataFrame, weather: DataFrame) -> DataFrame:
    table = encoded(difference_table(outcomes, weather))
    return fits.fit_boosted(table.filter(TRAIN)).transform(table)


def scored_durations(trips: DataFrame) -> DataFrame:
    return fitted_durations(trips)[0]


def fitted_durations(trips: DataFrame) -> tuple[DataFrame, GeneralizedLinearRegressionModel]:
    """The scored cells, and the model for its :func:`wayfare.models.fits.glm_summary`."""
    table = encoded(duration_table(trips), [*WEATHER_MEASURES, "count"])
    model = fits.fit_log_linear(table.filter(TRAIN))
    return model.transform(table), model

"""The three models and their evaluation over weighted cells."""

from functools import reduce

from pyspark.ml.regression import (
    GBTRegressor,
    GeneralizedLinearRegression,
    GeneralizedLinearRegressionModel,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.calendar import weekday_name
from wayfare.models.cells import weighted_mean
from wayfare.models.features import feature_width
from wayfare.models.perceptron import fit_perceptron
from wayfare.operators.sides import bounded_side, materialise

# Settings of the study's models.
HIDDEN_UNITS, CLASSES, MLP_ITERATIONS, MLP_SEED = 100, 2, 50, 669
GBT_ITERATIONS, GBT_DEPTH, GBT_SEED = 20, 8, 669
GLM_ITERATIONS, GLM_REGULARISATION = 10, 0.3


def fit_classifier(train: DataFrame, iterations: int = MLP_ITERATIONS):
    """Perceptron on encoded class cells, each counted by its weight."""
    layers = [feature_width(train), HIDDEN_UNITS, CLASSES]
    return fit_perceptron(train, layers, iterations, MLP_SEED)


def fit_boosted(train: DataFrame, iterations: int = GBT_ITERATIONS, depth: int = GBT_DEPTH):
    return GBTRegressor(
        maxIter=iterations, maxDepth=depth, seed=GBT_SEED, weightCol="weight"
    ).fit(train)


def fit_log_linear(train: DataFrame, penalty: float = GLM_REGULARISATION):
    """Gaussian with a log link: every label must be positive."""
    return GeneralizedLinearRegression(
        family="gaussian",
        link="log",
        maxIter=GLM_ITERATIONS,
        regParam=penalty,
        weightCol="weight",
    ).fit(train.filter(F.col("label") > 0))


def glm_summary(model: GeneralizedLinearRegressionModel, names: list[str]) -> DataFrame:
    """Coefficients of a fitted log-linear model with what can be said of each, and the fit as rows.

    term, coefficient, and for models without a penalty standard error, t and p; then `(deviance)`,
    `(null deviance)`, `(dispersion)` and `(aic)` with their value as coefficient. ``names`` are
    those of the features, in order.
    """
    summary = model.summary
    values = [*model.coefficients, model.intercept]
    try:
        spread = list(zip(summary.coefficientStandardErrors, summary.tValues, summary.pValues))
    except Exception:  # penalised fits have no standard errors
        spread = [(None, None, None)] * len(values)
    rows = [
        (term, float(value), *(None if x is None else float(x) for x in errors))
        for term, value, errors in zip([*names, "(intercept)"], values, spread)
    ]
    figures = {
        "(deviance)": summary.deviance,
        "(null deviance)": summary.nullDeviance,
        "(dispersion)": summary.dispersion,
        "(aic)": summary.aic,
    }
    rows += [(term, float(value), None, None, None) for term, value in figures.items()]
    return SparkSession.active().createDataFrame(
        rows, "term string, coefficient double, standard_error double, t double, p double"
    )


def confusion(scored: DataFrame, *by: str) -> DataFrame:
    """Weighted label by prediction counts; both classes always have a column."""
    table = (
        scored.groupBy(*by, F.col("label").cast("int").alias("label"))
        .pivot("prediction", [0.0, 1.0])
        .agg(F.sum("weight"))
        .na.fill(0.0)
    )
    return table.toDF(*by, "label", "predicted_0", "predicted_1")


def class_metrics(table: DataFrame, *by: str) -> DataFrame:
    """Weighted precision, weighted recall and accuracy from a confusion table."""

    def cell(label: int, predicted: int) -> Column:
        return F.coalesce(
            F.sum(F.when(F.col("label") == label, F.col(f"predicted_{predicted}"))), F.lit(0.0)
        )

    cells = table.groupBy(*by).agg(
        *[cell(a, p).alias(f"n{a}{p}") for a in (0, 1) for p in (0, 1)]
    )
    n00, n01, n10, n11 = (F.col(f"n{a}{p}") for a in (0, 1) for p in (0, 1))
    total = n00 + n01 + n10 + n11
    zero = F.lit(0.0)

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(zero)

    precision = share(n00, n00 + n10) * (n00 + n01) + share(n11, n01 + n11) * (n10 + n11)
    return cells.select(
        *by,
        (precision / total).alias("weighted_precision"),
        ((n00 + n11) / total).alias("weighted_recall"),
        ((n00 + n11) / total).alias("accuracy"),
    )


def regression_metrics(scored: DataFrame, *by: str) -> DataFrame:
    """RMSE, R2 and naive RMSE over the trips or pairs that the cells stand for.

    The squares within a cell are added to the cell's own error, so the figures are those
    of the single rows. Labels are squared as differences from their group's mean, which is found
    first. A single row has no spread: null.
    """
    w, y, p = F.col("weight"), F.col("label"), F.col("prediction")
    groups = [f"_by{i}" for i in range(len(by))]
    kept = materialise(
        scored.select(
            F.lit(0).alias("_all"), *[F.col(f"`{c}`").alias(g) for c, g in zip(by, groups)],
            "weight", "label", "prediction", "within",
        )
    )
    means = bounded_side(
        kept.groupBy("_all", *groups).agg(weighted_mean(y, w).alias("mean")).withColumnsRenamed({g: f"{g}_m" for g in ["_all", *groups]})
    )
    same = [F.col(g).eqNullSafe(F.col(f"{g}_m")) for g in ["_all", *groups]]
    sums = kept.join(means, reduce(lambda a, b: a & b, same)).groupBy("_all", *groups).agg(
        F.sum("weight").alias("n"),
        F.sum(w * F.pow(y - p, 2) + F.col("within")).alias("sse"),
        F.sum(w * F.pow(y - F.col("mean"), 2) + F.col("within")).alias("sst"),
    )
    return sums.select(
        *[F.col(g).alias(c) for c, g in zip(by, groups)],
        F.col("n").alias("rows"),
        F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
        (1 - F.try_divide(F.col("sse"), F.col("sst"))).alias("r2"),
        F.sqrt(F.try_divide(F.col("sst"), F.col("n") - 1)).alias("naive_rmse"),
    )


def error_by_weekday(scored: DataFrame, month: int | None = None) -> DataFrame:
    """Mean absolute prediction and label by month and weekday, in long form."""
    w = F.col("weight")
    chosen = scored if month is None else scored.filter(F.col("month") == month)
    means = chosen.groupBy("month", "day_of_week").agg(
        weighted_mean(F.col("prediction"), w).alias("Prediction"),
        weighted_mean(F.col("label"), w).alias("Actual"),
    )
    return means.unpivot(
        ["month", "day_of_week"], ["Prediction", "Actual"], "hue", "avg"
    ).select("month", weekday_name(F.col("day_of_week")).alias("days"), "hue", F.abs("avg").alias("avg"))

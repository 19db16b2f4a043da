"""Training tables as weighted cells.

All features of a trip are functions of its hour and zone pair, so many trips share one
feature row. Trips are grouped to one row per distinct feature row with its weight, the mean
of the label and the spread around it. Least-squares losses over the cells differ from those
over the trips by a constant, so fits agree while the table no longer grows with the trips.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.operators.sides import bounded_side

# The categorical features and the measured ones.
CATEGORIES = ["month", "time_bin", "PULocationID", "DOLocationID", "day_of_week", "weather_pattern"]


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.sum(value * weight) / F.sum(weight)


def label_cells(
    rows: DataFrame, label: str, features: list[str], weight: str | None = None
) -> DataFrame:
    """One row per distinct feature row: ``weight``, mean ``label`` and ``within`` squares.

    ``weight`` names a column saying how often a row counts, such as the merged table's
    ``pairs``; without it every row counts once. Squares are of what labels differ from their cell's
    mean, so large labels do not swallow a small spread: Spark's variance adds these up in one pass,
    and with weights the means are found first.
    """
    named = [f"`{c}`" for c in features]
    value = F.col(label).cast("double")
    if weight is None:
        n = F.count(F.lit(1))
        return (
            rows.na.drop()
            .groupBy(*named)
            .agg(n.cast("double").alias("weight"), F.avg(value).alias("label"), (F.var_pop(value) * n).alias("within"))
        )
    kept = rows.na.drop().select(*named, value.alias("_value"), F.col(weight).cast("double").alias("_weight"))
    w = F.col("_weight")
    means = bounded_side(
        kept.groupBy(*named).agg(F.sum(w).alias("weight"), weighted_mean(F.col("_value"), w).alias("label"))
    )
    away = w * F.pow(F.col("_value") - F.col("label"), 2)
    return kept.join(means, features).groupBy(*named, "weight", "label").agg(F.sum(away).alias("within"))


def difference_cells(outcomes: DataFrame, features: DataFrame, join_keys: list[str]) -> DataFrame:
    """Cells of the paired difference: a key of :func:`key_outcomes` is one cell.

    ``features`` is a join side with further columns of the key (the weather of its hour).
    """
    n = F.col("pairs").cast("double")
    total, squares = F.col("difference_sum").cast("double"), F.col("difference_squares").cast("double")
    return (
        outcomes.join(features, join_keys)
        .withColumns(
            {
                "weight": n,
                "label": total / n,
                "within": F.greatest(squares - total * total / n, F.lit(0.0)),
            }
        )
        .drop("pairs", "difference_sum", "difference_squares")
        .na.drop()
    )


def class_cells(outcomes: DataFrame, features: DataFrame, join_keys: list[str]) -> DataFrame:
    """Cells of the better-mode class: up to two rows per key, weighted by their pairs."""
    slower = F.col("taxi_slower_pairs")
    classes = F.array(
        F.struct(F.lit(0.0).alias("label"), (F.col("pairs") - slower).cast("double").alias("weight")),
        F.struct(F.lit(1.0).alias("label"), slower.cast("double").alias("weight")),
    )
    return (
        outcomes.join(features, join_keys)
        .withColumn("class", F.explode(classes))
        .select("*", "class.label", "class.weight")
        .drop("class", "pairs", "difference_sum", "difference_squares", "taxi_slower_pairs")
        .filter("weight > 0")
        .na.drop()
    )


def class_totals(cells: DataFrame, *by: str) -> DataFrame:
    """What each class weighs: the rows that a fit on these cells stands for."""
    return cells.groupBy(*by, "label").agg(F.sum("weight").alias("rows"))


def category_levels(cells: DataFrame, categories: list[str], train: str) -> DataFrame:
    """Per category value: its index by falling train weight, ties by the value's text.

    Values outside the training rows get weight 0 and come last, so that later splits hold
    no unknown value while the frequencies are the training ones.
    """
    values = F.array(
        *[F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("value")) for c in categories]
    )
    in_train = F.when(F.expr(train), F.col("weight")).otherwise(0.0)
    totals = cells.select(in_train.alias("w"), F.inline(values))
    return totals.groupBy("category", "value").agg(F.sum("w").alias("weight"))


def weighted_scales(cells: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample deviation per column over the weighted rows (one row of numbers)."""
    n = F.sum("weight")
    means = cells.agg(n.alias("n"), *[weighted_mean(F.col(f"`{c}`"), F.col("weight")).alias(c) for c in columns]).first()
    if not means["n"]:
        raise ValueError("no training rows")
    squares = cells.agg(
        *[F.sum(F.pow(F.col(f"`{c}`") - means[c], 2) * F.col("weight")).alias(c) for c in columns]
    ).first()
    return {c: (means[c], (squares[c] / max(means["n"] - 1, 1)) ** 0.5) for c in columns}

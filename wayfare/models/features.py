"""Feature encoding: frequency index, one-hot, scaling and assembly, fitted on train rows."""

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.models.cells import CATEGORIES, category_levels, weighted_scales
from wayfare.sources.schemas import WEATHER_MEASURES


@dataclass(frozen=True)
class Encoder:
    """Levels per category in index order, and (mean, deviation) per scaled column."""

    levels: dict[str, list[str]]
    scales: dict[str, tuple[float, float]]
    plain: tuple[str, ...] = ("peak_hours",)

    def transform(self, rows: DataFrame) -> DataFrame:
        """Adds ``features``: one-hot categories (last level dropped), plain and scaled columns.

        Scaled columns are divided by the deviation and not centred; a constant column
        becomes 0.
        """
        scaled = {
            f"{c}_scaled": F.col(f"`{c}`") / deviation if deviation else F.lit(0.0)
            for c, (_, deviation) in self.scales.items()
        }
        names = list(self.levels)
        stages = [
            # One model per column: the multi-column form pads shorter lists with null labels.
            *[
                StringIndexerModel.from_labels(labels, inputCol=c, outputCol=f"{c}_index")
                for c, labels in self.levels.items()
            ],
            OneHotEncoder(
                inputCols=[f"{c}_index" for c in names],
                outputCols=[f"{c}_encoded" for c in names],
                dropLast=True,
            ),
            VectorAssembler(
                inputCols=[*[f"{c}_encoded" for c in names], *self.plain, *scaled],
                outputCol="features",
            ),
        ]
        prepared = rows.withColumns(scaled)
        encoded = Pipeline(stages=stages).fit(prepared).transform(prepared)
        return encoded.drop(*[f"{c}_index" for c in names], *[f"{c}_encoded" for c in names], *scaled)


def index_levels(levels: DataFrame) -> DataFrame:
    """``index`` by falling weight, and the one-hot ``slot`` (null for the dropped last)."""
    by_weight = Window.partitionBy("category").orderBy(F.desc("weight"), "value")
    last = F.count(F.lit(1)).over(Window.partitionBy("category")) - 1
    index = F.row_number().over(by_weight) - 1
    return levels.withColumn("index", index).withColumn(
        "slot", F.when(F.col("index") < last, F.col("index"))
    )


def fit_encoder(
    cells: DataFrame,
    train: str,
    categories: list[str] = CATEGORIES,
    measures: list[str] = WEATHER_MEASURES,
) -> Encoder:
    """Learns from the cells for which the condition ``train`` holds. The levels reach the driver as any label map does."""
    rows = index_levels(category_levels(cells, categories, train)).orderBy("category", "index").collect()
    levels = {c: [r["value"] for r in rows if r["category"] == c] for c in categories}
    # A single level leaves nothing to encode after the last one is dropped.
    usable = {c: values for c, values in levels.items() if len(values) > 1}
    return Encoder(usable, weighted_scales(cells.filter(train), measures))


def feature_width(encoded: DataFrame) -> int:
    return encoded.schema["features"].metadata["ml_attr"]["num_attrs"]

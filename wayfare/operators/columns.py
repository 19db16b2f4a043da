"""Column selection by place, relabelling and tagging."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_place(df: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """The columns of a positional slice; negative places count from the end."""
    return df.select(*[f"`{c}`" for c in df.columns[start:stop]])


def relabelled(df: DataFrame, names: list[str]) -> DataFrame:
    return df.toDF(*names)


def tagged(df: DataFrame, name: str, value) -> DataFrame:
    """A constant column that tells apart the parts of a later union."""
    return df.withColumn(name, F.lit(value))

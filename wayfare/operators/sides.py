"""Join sides whose size is measured before Spark is told to broadcast them."""

from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.session import shared_folder

# Largest side, in estimated bytes, that is sent to every executor.
BROADCAST_LIMIT = 64 * 1024 * 1024


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 24
    if isinstance(kind, T.StructType):
        return reduce(
            lambda total, f: total + _value_bytes(value[f.name], f.dataType), kind.fields, F.lit(16)
        )
    if isinstance(kind, T.ArrayType):
        sizes = F.aggregate(
            F.coalesce(value, F.array().cast(kind)),
            F.lit(0).cast("long"),
            lambda total, item: total + _value_bytes(item, kind.elementType),
        )
        return sizes + 24
    return F.lit(16)


def materialise(df: DataFrame) -> DataFrame:
    """The frame computed once into the shared folder; later readers start from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written_table(df: DataFrame) -> DataFrame:
    """Like :func:`materialise`, as Parquet: for results large enough to profit from columns."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_side(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """A join side that is broadcast only if it was measured to fit.

    The side is computed once into the shared folder and measured in that same job. Over the
    limit it is returned without a hint: Spark then shuffles both inputs and AQE splits the
    hot keys, which is exact too because every caller joins against unique keys.
    """
    kept, size = measured(df)
    return F.broadcast(kept) if size <= limit else kept


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """The frame computed once into the shared folder, and its estimated bytes."""
    row = reduce(
        lambda total, f: total + _value_bytes(F.col(f"`{f.name}`"), f.dataType),
        df.schema.fields,
        F.lit(32),
    )
    size = Observation()
    kept = materialise(df.observe(size, F.sum(row.cast("long")).alias("bytes")))
    return kept, size.get["bytes"] or 0


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Raises if a key occurs twice: a left join would then multiply trips."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"duplicate key {repeated[0]} in join side {keys}")
    return df

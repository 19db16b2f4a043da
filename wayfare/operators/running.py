"""Running totals within groups of any size."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.operators.sides import materialise


def with_running(
    rows: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column] | None = None,
    lows: dict[str, Column] | None = None,
) -> DataFrame:
    """Adds running sums and minima up to and with each row, in ``order`` within ``groups``.

    A window would take a whole group into one task. Here rows are dealt by range of group and order,
    each task runs over its own rows, and what the tasks before it reached in the same group, one row
    per task and group, is added. Nulls neither add nor lower. ``order`` should tell the rows of a group
    apart as far as they matter: equal ones stay in one task.
    """
    sums, lows = sums or {}, lows or {}
    groups, kept = list(groups), rows.columns
    measured = rows.withColumns({f"_{name}": value for name, value in (sums | lows).items()})
    dealt = materialise(
        measured.repartitionByRange(*groups, *order).withColumn("_part", F.spark_partition_id())
    )
    totals = dealt.groupBy(*groups, "_part").agg(
        *[F.sum(f"_{name}").alias(f"_{name}") for name in sums],
        *[F.min(f"_{name}").alias(f"_{name}") for name in lows],
    )
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *groups,
        "_part",
        *[F.sum(f"_{name}").over(before).alias(f"_before_{name}") for name in sums],
        *[F.min(f"_{name}").over(before).alias(f"_before_{name}") for name in lows],
    )
    own = Window.partitionBy(*groups, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = dealt.join(carried, [*groups, "_part"])
    return running.select(
        *[f"`{c}`" for c in kept],
        *[
            (F.coalesce(F.sum(f"_{name}").over(own), F.lit(0)) + F.coalesce(f"_before_{name}", F.lit(0))).alias(name)
            for name in sums
        ],
        *[F.least(F.min(f"_{name}").over(own), F.col(f"_before_{name}")).alias(name) for name in lows],
    )

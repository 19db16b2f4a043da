"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm import frames


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (a, b), a > b, moved to the least neighbour of one end.

    Large: every greater neighbour of a node is linked to the node's least neighbour. Small: every
    lesser neighbour is, and so is the node.
    """
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    own = links.unionByName(turned) if large else links
    # Aggregated before the shuffle, so a node with very many links is one row from each task.
    least = own.groupBy("a").agg(F.min("b").alias("m"))
    if large:
        least = least.select("a", F.least("a", "m").alias("m"))
    joined = own.join(least, "a")
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter("a <> b").distinct()


def _forest(links: DataFrame) -> DataFrame:
    """The links of every batch of rows as stars: as connected, but fewer and without chains."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parent: dict[int, int] = {}

            def top(node: int) -> int:
                while (up := parent.setdefault(node, node)) != node:
                    parent[node] = node = parent[up]
                return node

            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
            ends = [(node, top(node)) for node in list(parent) if top(node) != node]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in ends], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    return links.mapInArrow(shrink, "a long, b long")


def _settled(links: DataFrame) -> bool:
    """Whether all links go from a node of one link to a node that itself has none upwards."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    found = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return found.filter("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node that has a link; label is the least node it reaches.

    links has long columns a and b. Each round is written to the shared folder, so lost executors
    cost one round at most; the rounds grow with the logarithm of the longest path.
    """
    frames.importable(links.sparkSession)
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = frames.written(_forest(links.filter("a <> b")).distinct())
    while not _settled(current):
        found = frames.written(_star(_star(current, True), False))
        frames.removed(current)
        current = found
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)

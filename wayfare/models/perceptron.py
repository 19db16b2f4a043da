"""A perceptron trained on weighted cells.

The cells are packed once into blocks of rows in the shared folder. Every step of the minimiser is one
Spark job: tasks add up the weighted loss and gradient of their blocks, a second round of tasks adds
those up, and a few vectors of the parameters' width reach the driver. Nothing is repeated or drawn, so
the work grows with the cells and not with the trips or pairs that they stand for.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.models.descent import minimise
from wayfare.operators.sides import written_table

# Cells that a task holds as one dense matrix, and the tasks that add up the others' gradients.
BLOCK_ROWS, ADDERS = 1024, 32

BLOCK = "labels binary, weights binary, lengths binary, places binary, numbers binary"
PART = "part int, loss double, weight double, gradient binary"


def packed_blocks(cells: DataFrame) -> DataFrame:
    """``features``, ``label`` and ``weight`` as blocks of sparse rows, written once.

    Cells without weight take no part.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(first, BLOCK_ROWS)
                rows = part.column(0).to_pylist()
                places, numbers = [], []
                for row in rows:
                    values = np.asarray(row["values"], float)
                    own = np.flatnonzero(values) if row["type"] else np.arange(len(values))
                    known = own if row["type"] else np.asarray(row["indices"], np.int64)
                    places.append(known)
                    numbers.append(values[own])
                arrays = [
                    part.column(1).to_numpy(zero_copy_only=False).astype("<i4"),
                    part.column(2).to_numpy(zero_copy_only=False).astype("<f8"),
                    np.array([len(x) for x in places], "<i4"),
                    np.concatenate(places).astype("<i4"),
                    np.concatenate(numbers).astype("<f8"),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes()], pa.binary()) for x in arrays],
                    names=["labels", "weights", "lengths", "places", "numbers"],
                )

    chosen = cells.filter("weight > 0").select(
        "features", F.col("label").cast("double"), F.col("weight").cast("double")
    )
    return written_table(chosen.mapInArrow(pack, BLOCK))


def layer_parts(layers: Sequence[int], parameters: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, one row per input; offsets) of every layer. A layer's weights lie output by output
    for each input, then its offsets, as in Spark's perceptron."""
    parts, at = [], 0
    for inputs, outputs in zip(layers, layers[1:]):
        middle, end = at + inputs * outputs, at + inputs * outputs + outputs
        parts.append((parameters[at:middle].reshape(inputs, outputs), parameters[middle:end]))
        at = end
    return parts


def parameter_count(layers: Sequence[int]) -> int:
    return sum((a + 1) * b for a, b in zip(layers, layers[1:]))


def starting_parameters(layers: Sequence[int], seed: int) -> np.ndarray:
    """Uniform weights, narrower for wider layers; no offsets."""
    chance, parts = np.random.default_rng(seed), []
    for inputs, outputs in zip(layers, layers[1:]):
        reach = (6.0 / (inputs + outputs)) ** 0.5
        parts += [chance.uniform(-reach, reach, inputs * outputs), np.zeros(outputs)]
    return np.concatenate(parts)


def block_loss(
    layers: Sequence[int], parameters: np.ndarray, rows: np.ndarray, labels: np.ndarray, weights: np.ndarray
) -> tuple[float, np.ndarray]:
    """Weighted cross entropy of logistic layers under a softmax, and its gradient, both as sums."""
    parts = layer_parts(layers, parameters)
    states = [rows]
    for k, (matrix, offset) in enumerate(parts):
        drive = states[-1] @ matrix + offset
        if k < len(parts) - 1:
            with np.errstate(over="ignore"):
                states.append(1.0 / (1.0 + np.exp(-drive)))
    drive -= drive.max(axis=1, keepdims=True)
    shares = np.exp(drive)
    totals = shares.sum(axis=1, keepdims=True)
    own = np.arange(len(labels)), labels
    loss = float(weights @ (np.log(totals[:, 0]) - drive[own]))
    error = shares / totals
    error[own] -= 1.0
    error *= weights[:, None]
    gradients: list[np.ndarray] = []
    for k in range(len(parts) - 1, -1, -1):
        gradients = [(states[k].T @ error).ravel(), error.sum(axis=0), *gradients]
        if k:
            error = (error @ parts[k][0].T) * states[k] * (1.0 - states[k])
    return loss, np.concatenate(gradients)


def total_loss(blocks: DataFrame, layers: Sequence[int], parameters: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean loss and gradient over the weight of all blocks."""
    context = blocks.sparkSession.sparkContext
    shared = context.broadcast(parameters)
    width = parameter_count(layers)

    def gradients(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, weight, total = 0.0, 0.0, np.zeros(width)
        for batch in batches:
            for row in batch.to_pylist():
                labels = np.frombuffer(row["labels"], "<i4")
                weights = np.frombuffer(row["weights"], "<f8")
                owners = np.repeat(np.arange(len(labels)), np.frombuffer(row["lengths"], "<i4"))
                dense = np.zeros((len(labels), layers[0]))
                dense[owners, np.frombuffer(row["places"], "<i4")] = np.frombuffer(row["numbers"], "<f8")
                part, gradient = block_loss(layers, shared.value, dense, labels, weights)
                loss, weight, total = loss + part, weight + float(weights.sum()), total + gradient
        if weight:
            yield part_row(loss, weight, total)

    def part_row(loss: float, weight: float, total: np.ndarray) -> pa.RecordBatch:
        part = pa.array([TaskContext.get().partitionId() % ADDERS], pa.int32())
        return pa.RecordBatch.from_arrays(
            [part, pa.array([loss]), pa.array([weight]), pa.array([total.tobytes()], pa.binary())],
            names=["part", "loss", "weight", "gradient"],
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, weight, total = 0.0, 0.0, np.zeros(width)
        for batch in batches:
            for row in batch.to_pylist():
                loss, weight = loss + row["loss"], weight + row["weight"]
                total += np.frombuffer(row["gradient"])
        if weight:
            yield part_row(loss, weight, total)

    parts = blocks.mapInArrow(gradients, PART).repartition("part").mapInArrow(added, PART).collect()
    shared.destroy()
    weight = sum(row["weight"] for row in parts)
    if not weight:
        raise ValueError("no training rows")
    gradient = sum(np.frombuffer(row["gradient"]) for row in parts)
    return sum(row["loss"] for row in parts) / weight, gradient / weight


def fit_perceptron(
    cells: DataFrame,
    layers: Sequence[int],
    iterations: int,
    seed: int = 0,
    start: np.ndarray | None = None,
    tolerance: float = 1e-6,
) -> MultilayerPerceptronClassificationModel:
    """The perceptron that a fit on every cell repeated by its weight would give.

    ``layers`` are the widths from the features to the classes; labels are 0, 1, ... Weights need not be
    whole. The result is Spark's own model, so it scores inside the JVM.
    """
    session = cells.sparkSession
    blocks = packed_blocks(cells)
    first = starting_parameters(layers, seed) if start is None else start
    best, _ = minimise(
        lambda place: total_loss(blocks, layers, place), first, iterations, tolerance
    )
    # Spark builds its model from given parameters when it is asked for no iterations.
    empty = Vectors.sparse(layers[0], [], [])
    rows = session.createDataFrame([(empty, float(k)) for k in range(layers[-1])], ["features", "label"])
    carrier = MultilayerPerceptronClassifier(
        layers=list(layers), maxIter=0, initialWeights=Vectors.dense(best)
    )
    return carrier.fit(rows)

"""Best-fit packing by minimum bin slack over the lengths that documents have.

Documents of the same length are interchangeable, so sequences are planned on the counts by length:
at most `capacity` numbers, however many documents there are. Per sequence, a bitset holds which
sums the available lengths reach together with the longest one; the fullest feasible combination is
taken and, as its lengths are left often enough, repeated. The plan maps (length, rank among the
pieces of that length) to a sequence and a place; pieces find their rank from counts by write task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.llm import frames
from wayfare.llm.vocabulary import encoder

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, __task int, __nth long"
)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How often each length is used in the fullest set that holds the longest length.

    reach[k] has bit s set if the first k of the taken steps can sum up to s. Lengths go from long
    to short, so of equally full sets one with longer members is found. A length with count c is
    offered as 1, 2, 4, ... copies, no more than fit.
    """
    longest = max(counts)
    room = capacity - longest
    steps, reach = [], [1]
    keep = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, copies = min(counts[length] - (length == longest), room // length), 1
        while left > 0 and not reach[-1] >> room & 1:
            take = min(copies, left)
            if take * length <= room:
                steps.append((length, take))
                reach.append((reach[-1] | reach[-1] << take * length) & keep)
            left, copies = left - take, copies * 2
        if reach[-1] >> room & 1:
            break
    at = reach[-1].bit_length() - 1
    used = {longest: 1}
    for k in range(len(steps), 0, -1):
        if not reach[k - 1] >> at & 1:
            length, take = steps[k - 1]
            used[length] = used.get(length, 0) + take
            at -= take * length
    return used


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, repeats, first sequence, offset) of every run of equal sequences.

    A run uses `repeats` ranks for each of its copies of a length; copies lie side by side.
    """
    left = {length: count for length, count in counts.items() if count > 0}
    taken = dict.fromkeys(left, 0)
    runs, sequence = [], 0
    while left:
        used = fullest(left, capacity)
        repeats = min(left[length] // copies for length, copies in used.items())
        offset = 0
        for length, copies in sorted(used.items(), reverse=True):
            runs.append((length, taken[length], repeats, sequence, offset))
            taken[length] += copies * repeats
            left[length] -= copies * repeats
            offset += copies * length
            if not left[length]:
                del left[length]
        sequence += repeats
    return runs


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Documents as pieces of at most capacity ids, numbered by task and length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known = encoder(tokenizer)
        end = np.array([end_id], known.width).tobytes()
        task, seen = TaskContext.get().partitionId(), {}
        for batch in frames.shorter(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(known.packed(text) + end, known.width).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity]
                    nth = seen.get(len(own), 0)
                    seen[len(own)] = nth + 1
                    rows.append((doc_id, piece, start, len(own), zlib.crc32(own), task, nth))
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "__task", "__nth"]
            if rows:
                arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return frames.texts(docs).mapInArrow(cut, PIECES)


def packed(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0
) -> DataFrame:
    """Packs every document into sequences of at most capacity ids, one row per piece.

    doc_id, piece, start, length, ids_crc32, sequence_id, offset. A document is its ids and end_id;
    only longer ones are cut, into pieces of capacity. Null and empty texts are the end id alone.
    Ids may be null or repeat: each row is a document. An empty table gives no rows. Other columns
    are not read.
    """
    pieces = frames.written(pieces_of(docs, tokenizer, capacity, end_id))
    own = pieces.groupBy("__task", "length").agg(F.count("*").alias("__own"))
    earlier = (
        Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = own.select(
        "__task", "length", F.coalesce(F.sum("__own").over(earlier), F.lit(0)).alias("__before")
    )
    # At most `capacity` rows.
    counts = {row["length"]: row["n"] for row in own.groupBy("length").agg(
        F.sum("__own").alias("n")).collect()}
    runs = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 5)
    shared = docs.sparkSession.sparkContext.broadcast(runs)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        # Runs are sorted by (length, first rank): one key per run for a binary search.
        wide = int(runs[:, 1].max()) + 1 if len(runs) else 1
        keys = runs[:, 0] * wide + runs[:, 1]
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            run = runs[np.searchsorted(keys, length * wide + np.minimum(rank, wide - 1), "right") - 1]
            inside = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5],
                    pa.array(run[:, 3] + inside % run[:, 2]),
                    pa.array(run[:, 4] + inside // run[:, 2] * length),
                ],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    ranked = pieces.join(before, ["__task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("__before") + F.col("__nth")).alias("__rank"),
    )
    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long"
    )
    return ranked.mapInArrow(place, schema)


def op7_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = frames.table(spark, folder, "documents")
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))

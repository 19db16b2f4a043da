"""Token ids as binary files: one concatenated id array with Elias-Fano document boundaries.

A file is a Parquet folder with one row per chunk, in ascending document order by (part, chunk):

* `ids`: the chunk's ids, little-endian, two bytes each if the vocabulary allows it;
* `ends`: the cumulative ends of its documents, Elias-Fano coded: `low_bits` low bits of each end
  packed together, then the high parts as a unary bit vector, with a sample of every 256th one-bit;
* `before`: the ids of the part's earlier chunks;
* `doc_ids`: the documents in order.

n documents over u ids take about 2 + log2(u / n) bits each. `Ends.select(i)` finds the i-th end from
the sample and a byte-wise count, so no table of 64-bit offsets is stored or built.
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

#: A chunk is closed once it holds so many ids; one longer document is a chunk of its own.
CHUNK_IDS = 1 << 20
#: Every so many one-bits, the place of one is stored.
SAMPLE = 256

COUNTS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1)

FILE = (
    "part int, chunk int, before long, n_docs int, n_ids long, id_bytes int, low_bits int, "
    "low binary, high binary, samples binary, ids binary, doc_ids array<long>"
)


def pack_ends(ends: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """(low bits, low parts, high parts, samples) of a non-decreasing array of positive ends."""
    count = len(ends)
    low_bits = max(0, int(ends[-1] // count).bit_length() - 1) if count else 0
    ends = ends.astype(np.uint64)
    low = (ends[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
    ones = (ends >> np.uint64(low_bits)).astype(np.int64) + np.arange(count)
    bits = np.zeros(int(ones[-1]) + 1 if count else 0, np.uint8)
    bits[ones] = 1
    return (
        low_bits,
        np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes(),
        np.packbits(bits, bitorder="little").tobytes(),
        ones[::SAMPLE].astype("<u4").tobytes(),
    )


class Ends:
    """Reads single ends, or all of them, from the coded form."""

    def __init__(self, count: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.count, self.low_bits = count, low_bits
        self.low = np.frombuffer(low, np.uint8)
        self.high = np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    def select(self, index: int) -> int:
        """The index-th end (from 0)."""
        at, left = int(self.samples[index // SAMPLE]), index % SAMPLE
        byte, value = at // 8, int(self.high[at // 8]) >> (at % 8)
        shift = at % 8
        while (here := int(COUNTS[value])) <= left:  # whole bytes first
            left -= here
            byte, shift = byte + 1, 0
            value = int(self.high[byte])
        for _ in range(left):
            value &= value - 1
        place = byte * 8 + shift + ((value & -value).bit_length() - 1)
        first = index * self.low_bits
        bits = [(int(self.low[b // 8]) >> (b % 8)) & 1 for b in range(first, first + self.low_bits)]
        return ((place - index) << self.low_bits) | sum(bit << k for k, bit in enumerate(bits))

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count]
        bits = np.unpackbits(self.low, bitorder="little")[: self.count * self.low_bits]
        weights = np.int64(1) << np.arange(self.low_bits, dtype=np.int64)
        low = bits.reshape(self.count, self.low_bits).astype(np.int64) @ weights
        return ((ones - np.arange(self.count)) << self.low_bits) | low


def write_ids(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 0,
    chunk_ids: int = CHUNK_IDS,
) -> None:
    """Writes every document's ids, each followed by end_id, in ascending doc_id order.

    Null texts are empty documents. Null ids come first, equal ids are ordered by text. An empty
    table gives an empty file. Other columns are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known = encoder(tokenizer)
        part, chunk = TaskContext.get().partitionId(), 0
        end = np.array([end_id], known.width).tobytes()
        pieces: list[bytes] = []
        ids: list[int | None] = []
        held = before = 0

        def closed() -> pa.RecordBatch:
            sizes = np.array([len(piece) for piece in pieces], np.int64) // known.width.itemsize
            low_bits, low, high, samples = pack_ends(np.cumsum(sizes))
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "chunk": pa.array([chunk], pa.int32()),
                    "before": pa.array([before], pa.int64()),
                    "n_docs": pa.array([len(ids)], pa.int32()),
                    "n_ids": pa.array([int(sizes.sum())], pa.int64()),
                    "id_bytes": pa.array([known.width.itemsize], pa.int32()),
                    "low_bits": pa.array([low_bits], pa.int32()),
                    "low": pa.array([low], pa.binary()),
                    "high": pa.array([high], pa.binary()),
                    "samples": pa.array([samples], pa.binary()),
                    "ids": pa.array([b"".join(pieces)], pa.binary()),
                    "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                }
            )

        for batch in frames.shorter(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                piece = known.packed(text) + end
                if pieces and held + len(piece) > chunk_ids * known.width.itemsize:
                    yield closed()
                    before += held // known.width.itemsize
                    pieces, ids, held, chunk = [], [], 0, chunk + 1
                pieces.append(piece)
                ids.append(doc_id)
                held += len(piece)
        if pieces:
            yield closed()

    # All documents of an id are in one range, and ranges are numbered in the order of ids.
    parts = frames.texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    parts.mapInArrow(encode, FILE).write.mode("overwrite").parquet(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The chunks of a written file, with `base`, the ids of all chunks before."""
    chunks = spark.read.schema(FILE).parquet(folder)
    # One row per write task, so at most as many as there were shuffle partitions.
    totals = chunks.groupBy("part").agg(F.sum("n_ids").alias("__ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "part", F.coalesce(F.sum("__ids").over(earlier), F.lit(0)).alias("__earlier")
    )
    return chunks.join(F.broadcast(totals), "part").select(
        *chunks.columns, (F.col("__earlier") + F.col("before")).alias("base")
    )


def documents(chunks: DataFrame) -> DataFrame:
    """One row per document of read_ids(): doc_id, start, n_tokens, ids_crc32."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    columns = ["base", "n_docs", "id_bytes", "low_bits", "low", "high", "samples", "ids", "doc_ids"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                x = {name: batch.column(k)[row].as_py() for k, name in enumerate(columns)}
                own = (x["n_docs"], x["low_bits"], x["low"], x["high"], x["samples"])
                ends = Ends(*own).all()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ids = np.frombuffer(x["ids"], f"<u{x['id_bytes']}").astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(x["doc_ids"], pa.int64()),
                        pa.array(starts + x["base"], pa.int64()),
                        pa.array(ends - starts, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return chunks.select(*columns).mapInArrow(measure, schema)


def document_ids(chunks: DataFrame, doc_id: int) -> DataFrame:
    """The ids of one document, found with two selects: doc_id, ids."""
    schema = "doc_id long, ids array<long>"
    columns = ["n_docs", "id_bytes", "low_bits", "low", "high", "samples", "ids", "doc_ids"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                x = {name: batch.column(k)[row].as_py() for k, name in enumerate(columns)}
                own = (x["n_docs"], x["low_bits"], x["low"], x["high"], x["samples"])
                ends, out = Ends(*own), []
                for place in (k for k, own_id in enumerate(x["doc_ids"]) if own_id == doc_id):
                    first = ends.select(place - 1) if place else 0
                    size = ends.select(place) - first
                    ids = np.frombuffer(
                        x["ids"], f"<u{x['id_bytes']}", size, first * x["id_bytes"]
                    )
                    out.append(ids.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id] * len(out), pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                    names=["doc_id", "ids"],
                )

    holds = F.array_contains("doc_ids", F.lit(doc_id).cast("long"))
    return chunks.filter(holds).select(*columns).mapInArrow(find, schema)


def op5_elias_fano(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    target = frames.scratch(spark)
    write_ids(
        frames.table(spark, folder, "documents"), target, public_tokenizers.path("byte_bpe_50k.json")
    )
    return documents(read_ids(spark, target))

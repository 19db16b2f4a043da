"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.session import shared_folder

#: Bytes of text that numpy works on at once inside a task; a longer single text is a slice alone.
SLICE_BYTES = 2_000_000


#: The folder that holds the package.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package wherever the session was started."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{shared_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"


def written(frame: DataFrame) -> DataFrame:
    """Computes the frame once into the shared folder and reads it back (cuts lineage)."""
    folder = scratch(frame.sparkSession)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def removed(frame: DataFrame) -> None:
    """Deletes the files behind frames from written(), once nothing reads them any more."""
    session = frame.sparkSession
    path = session._jvm.org.apache.hadoop.fs.Path
    for name in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
        if "/table-" in name:
            folder = path(name)
            folder.getFileSystem(session._jsc.hadoopConfiguration()).delete(folder, True)


#: What Python workers keep between tasks, by the name of its user; each value is emptied at once.
_kept: dict[str, dict] = {}


def kept_by(user: str) -> dict:
    """A store that lasts as long as tasks of one user follow each other in a worker.

    Workers are used again by later stages, so another user's store is emptied here: a model does not
    stay in memory behind the stage that needs it.
    """
    others = [name for name in _kept if name != user]
    for name in others:
        _kept.pop(name).clear()
    if others or user not in _kept:  # what a stage before left free goes as well, once a stage
        _give_back()
    return _kept.setdefault(user, {}) if user else {}


def _give_back() -> None:
    """Returns freed memory to the machine, where its C library can; else the worker keeps it for later."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id and the text, whatever other columns there are; null texts are empty."""
    importable(docs.sparkSession)
    return docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def with_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As texts(), with the whole document as a struct `row`, so that decisions need no join back."""
    importable(docs.sparkSession)
    return docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
    )


def carrying(fields: str, docs: DataFrame) -> T.StructType:
    """The fields, and `row` if the frame has it."""
    found = T._parse_datatype_string(fields)
    return T.StructType(found.fields + [x for x in docs.schema.fields if x.name == "row"])


def carried(batch: pa.RecordBatch, arrays: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    """A batch of the arrays, and of the input's `row` if it has one."""
    if "row" in batch.schema.names:
        arrays, names = [*arrays, batch.column(batch.schema.names.index("row"))], [*names, "row"]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def raw_column(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts as UTF-8."""
    return column.cast(pa.binary()).to_pylist()


def shorter(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, so that few Python objects are held at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets with one more entry than rows) for runs of rows of about `size` bytes.

    The column is a string array without nulls.
    """
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(column))
        own = offsets[first : last + 1]
        yield first, data[own[0] : own[-1]], own - own[0]
        first = last


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All integers of the half-open intervals, one after another."""
    sizes = ends - starts
    out = np.ones(int(sizes.sum()), np.int64)
    keep = sizes > 0
    starts, ends, sizes = starts[keep], ends[keep], sizes[keep]
    if not len(starts):
        return out
    out[0] = starts[0]
    out[np.cumsum(sizes)[:-1]] = starts[1:] - ends[:-1] + 1
    return np.cumsum(out)


def code_points(raw: bytes, places: list[int]) -> list[int]:
    """Byte offsets of a UTF-8 text as code point offsets."""
    if not places or raw.isascii():
        return places
    lead = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return [int(lead[place - 1]) if place else 0 for place in places]

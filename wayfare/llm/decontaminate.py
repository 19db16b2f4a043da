"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

A text is normalised to its lower-case words with single spaces between and around them, so a window
of item words is found as plain text with word borders. Each text is scanned once, in C; only for
texts with hits are word numbers and offsets in the original text worked out.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import frames

#: Bytes of window text in one automaton; more are scanned for in several passes.
AUTOMATON_BYTES = 4_000_000

# A-Z to a-z, and every other byte outside 0-9, a-z and multi-byte characters to a space.
WORD_BYTES = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A
    else byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80
    else 0x20
    for byte in range(256)
)
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

HITS = (
    "doc_id long, n_words long, words array<struct<first:int,end:int>>, "
    "spans array<struct<start:int,end:int>>, items array<string>"
)
INTERVALS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(WORD_BYTES).split()


def windows_of(words: list[bytes], size: int) -> set[bytes]:
    if not words:
        return set()
    return {
        b" ".join(words[at : at + size]) for at in range(max(1, len(words) - size + 1))
    }


def windows(items: DataFrame, size: int, key: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (window, item): the item's id as text, or null if it has none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (window, item)
                for item, raw in zip(batch.column(0).to_pylist(), frames.raw_column(batch.column(1)))
                for window in windows_of(words_of(raw), size)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([window for window, _ in found], pa.binary()),
                    pa.array([item for _, item in found], pa.string()),
                ],
                names=["window", "item"],
            )

    items = items.select(
        F.col(key).cast("string").alias("item"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    return items.mapInArrow(cut, "window binary, item string").distinct()


def merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(intervals):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def _automaton(name: str, shared) -> ahocorasick.Automaton:
    """One per worker; name tells the broadcasts apart."""
    built = frames.kept_by(name)
    if not built:
        machine = ahocorasick.Automaton()
        for window, own in shared.value.items():
            shown = f" {window.decode('latin-1')} "
            machine.add_word(shown, (len(shown), window.count(b" ") + 1, own))
        machine.make_automaton()
        built[name] = machine
    return built[name]


def scan(raw: bytes, machine) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(words, merged intervals of hit word numbers, items)."""
    words = words_of(raw)
    if not words:
        return 0, [], set()
    text = b" " + b" ".join(words) + b" "
    found = list(machine.iter(text.decode("latin-1"))) if len(machine) else []
    if not found:
        return len(words), [], set()
    # A match ends at the space behind its last word; spaces before it count the words.
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
    ends = np.searchsorted(spaces, [place for place, _ in found])
    intervals = [(int(end) - count, int(end)) for end, (_, (_, count, _)) in zip(ends, found)]
    return len(words), merged(intervals), {x for _, (_, _, own) in found for x in own}


def _scanned(docs: DataFrame, shared, last: bool) -> DataFrame:
    """doc_id, n_words, words, spans and items, with `row` if docs have it. The text comes from there,
    so that it is sent once; where there is no row it goes on as `text` until the last pass."""
    name = uuid.uuid4().hex
    whole = "row" in docs.columns
    onward = [] if whole or last else ["text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(name, shared)
        for batch in frames.shorter(batches):
            before = batch.column(1).to_pylist()
            known = batch.column(2).to_pylist()
            text = batch.column(3)
            if whole:
                text = pc.fill_null(text.field("text").cast(pa.string()), "")
            counts, intervals, spans, items = [], [], [], []
            for row, raw in enumerate(frames.raw_column(text)):
                count, hit, own = scan(raw, machine)
                if before[row]:
                    hit = merged(hit + [(x["first"], x["end"]) for x in before[row]])
                    own |= set(known[row])
                places = [match.span() for match in WORD.finditer(raw)] if hit else []
                flat = [x for a, b in hit for x in (places[a][0], places[b - 1][1])]
                flat = frames.code_points(raw, flat)
                counts.append(count)
                intervals.append(hit)
                spans.append(list(zip(flat[::2], flat[1::2])))
                items.append(sorted(own))
            yield frames.carried(
                batch,
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(intervals, INTERVALS),
                    pa.array(spans, SPANS),
                    pa.array(items, pa.list_(pa.string())),
                    *(text for _ in onward),
                ],
                ["doc_id", "n_words", "words", "spans", "items", *onward],
            )

    fields = HITS + "".join(f", {column} string" for column in onward)
    docs = docs.select("doc_id", "words", "items", "row" if whole else "text")
    return docs.mapInArrow(run, frames.carrying(fields, docs))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    size: int = 13,
    share: int = 20,
    automaton_bytes: int = AUTOMATON_BYTES,
    rows: bool = False,
) -> DataFrame:
    """What each document holds of the items' windows of `size` consecutive words.

    One row per document: doc_id, n_words, n_hit (words inside any window found), items (their ids
    as text, sorted), spans (hit passages in code points of the original text) and contaminated
    (some word is hit, and share * n_hit >= n_words). Shorter items are one window. Null texts and
    texts without words have no words and no hits. Items with a null id count as hits but are not
    listed. Repeated documents and items are allowed; other columns are not read, but the whole
    document is returned as the struct `row` if asked for.
    """
    spark = docs.sparkSession
    found = windows(items, size).groupBy("window").agg(
        F.array_sort(F.collect_set("item")).alias("items")
    )
    found = frames.written(found)
    total = found.agg(F.sum(F.length("window") + F.size("items") * 8)).first()[0] or 0
    passes = int(total // automaton_bytes) + 1
    state = frames.with_rows(docs) if rows else frames.texts(docs)
    kept = ["row"] if rows else []
    state = state.select(
        "doc_id",
        F.lit(None).cast("array<struct<first:int,end:int>>").alias("words"),
        F.lit(None).cast("array<string>").alias("items"),
        "row" if rows else "text",
    )
    for k in range(passes):
        part = found.filter(F.pmod(F.xxhash64("window"), F.lit(passes)) == k)
        own = {bytes(row["window"]): tuple(row["items"]) for row in part.toLocalIterator()}
        shared = spark.sparkContext.broadcast(own)
        state = _scanned(state if k == 0 else frames.written(state), shared, k == passes - 1)
    frames.removed(found)
    hits = F.aggregate("words", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    found = state.select("doc_id", "n_words", hits.alias("n_hit"), "items", "spans", *kept)
    return found.withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))
    )


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = frames.table(spark, folder, "documents")
    found = contamination(docs, frames.table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


SQL = r"""
WITH item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL
), item_windows AS (
    SELECT DISTINCT item, least(13, len(w)) AS size,
        array_to_string(list_slice(w, p, p + least(13, len(w)) - 1), ' ') AS words
    FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS p
          FROM item_words WHERE len(w) > 0)
), doc_words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), doc_windows AS (
    SELECT doc_id, size, p, array_to_string(list_slice(w, p, p + size - 1), ' ') AS words
    FROM (SELECT doc_id, w, size, unnest(range(1, greatest(0, len(w) - size + 1) + 1)) AS p
          FROM doc_words, (SELECT DISTINCT size FROM item_windows))
), hits AS (
    SELECT DISTINCT d.doc_id, d.size, d.p, i.item
    FROM doc_windows d JOIN item_windows i ON d.words = i.words AND d.size = i.size
), counted AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM (SELECT doc_id, unnest(range(p, p + size)) AS pos FROM hits) GROUP BY doc_id
), listed AS (
    SELECT doc_id, count(DISTINCT item) AS n_items,
        string_agg(DISTINCT item, ',' ORDER BY item) AS items
    FROM hits GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN counted USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

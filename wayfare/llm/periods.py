"""Periodic runs of words by internal pattern matching.

A run of period q and length 4 q or more holds, for the power B of two with B <= q < 2 B, a whole block
of B words that starts at a multiple of B, and that block again q words on. So at every level every
block asks for its occurrences that start B to 2 B words behind it. Equal blocks are one interval of
the suffix array; a wavelet tree over the array answers the range successors. Occurrences in so narrow
a window form one arithmetic progression: one or two of them are candidates themselves, and of a
longer one, whose words repeat with its difference d, only the occurrence counts whose stretch of
period d ends q words behind the block's own. Candidates are extended by the classes of equal words.

All documents of a slice of a batch are indexed together, in numpy; their words are numbered apart, so
no occurrence lies in another document.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import frames

#: A run has at least so many words, and at least so many periods; the method needs four of these.
LEAST_WORDS, LEAST_PERIODS = 6, 4

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
RUN_LIST = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def words_of(raw: bytes) -> list[bytes]:
    """Between blanks and the control characters 9 to 13."""
    return raw.split()


def numbered(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """One number per word, the place of the word's first occurrence in its own document, with an end
    mark before and behind every document; and the place of each document's first word."""
    total = sum(map(len, documents)) + len(documents) + 1
    numbers = np.arange(total, dtype=np.int64)
    starts = np.empty(len(documents), np.int64)
    at = 1
    for row, words in enumerate(documents):
        starts[row] = at
        known: dict[bytes, int] = {}
        numbers[at : at + len(words)] = np.fromiter(
            map(known.setdefault, words, itertools.count(at)), np.int64, len(words)
        )
        at += len(words) + 1
    return numbers, starts


class Classes:
    """Classes of equal stretches of 1, 2, 4, ... words, by prefix doubling, and the suffix array.

    A class is named by the place where it begins in the suffix array. Levels end where no two
    stretches are equal.
    """

    def __init__(self, numbers: np.ndarray) -> None:
        size = len(numbers)
        order = np.argsort(numbers, kind="stable")
        names = np.empty(size, np.int32)
        self.levels: list[np.ndarray] = []
        open_ = np.arange(size)
        keys = numbers[order]
        while True:
            # open_: places of the array not yet settled; keys: what tells them apart, in order
            head = np.empty(len(open_), bool)
            head[:1] = True
            head[1:] = keys[1:] != keys[:-1]
            first = np.flatnonzero(head)
            members = np.diff(np.append(first, len(open_)))
            names[order[open_]] = np.repeat(open_[first], members)
            self.levels.append(names.copy())
            open_ = open_[np.repeat(members > 1, members)]
            if not len(open_):
                break
            width = 1 << (len(self.levels) - 1)
            places = order[open_]
            keys = names[places].astype(np.int64) * size + names[places + width]
            sorted_ = np.argsort(keys, kind="stable")
            keys = keys[sorted_]
            order[open_] = places[sorted_]
        self.order = order

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on; a and b differ."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names = self.levels[k]
            length += (names[a + length] == names[b + length]).astype(np.int64) << k
        return length

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a equal those before b; a < b."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names = self.levels[k]
            left = a - length - (1 << k)
            same = (left >= 0) & (names[np.maximum(left, 0)] == names[np.maximum(left, 0) + b - a])
            length += same.astype(np.int64) << k
        return length


class WaveletTree:
    """Numbers below 2**bits, level by level from the highest bit, zeros before ones."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values)).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            low = (values >> bit) & 1 == 0
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(low, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[low], values[~low]])

    def below(self, first: np.ndarray, end: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers of the places first to end are below the bound, itself below 2**bits."""
        count = np.zeros(len(first), np.int64)
        for level, before in enumerate(self.zeros):
            a, b = before[first], before[end]
            high = (bound >> (self.bits - 1 - level)) & 1 == 1
            count += np.where(high, b - a, 0)
            first = np.where(high, before[-1] + first - a, a)
            end = np.where(high, before[-1] + end - b, b)
        return count

    def smallest(self, first: np.ndarray, end: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The number of that rank, from 0, among the places first to end."""
        value = np.zeros(len(first), np.int64)
        rank = rank.astype(np.int64)
        for level, before in enumerate(self.zeros):
            a, b = before[first], before[end]
            high = rank >= b - a
            rank = rank - np.where(high, b - a, 0)
            value |= high.astype(np.int64) << (self.bits - 1 - level)
            first = np.where(high, before[-1] + first - a, a)
            end = np.where(high, before[-1] + end - b, b)
        return value


def candidates(classes: Classes, tree: WaveletTree, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of a block, period) of this level: the block stands again a period on."""
    names, width = classes.levels[level], 1 << level
    blocks = np.arange(0, len(names), width)
    sizes = np.bincount(names, minlength=len(names))
    first = names[blocks].astype(np.int64)
    several = sizes[first] > 1
    blocks, first = blocks[several], first[several]
    end = first + sizes[first]
    bound = len(names)
    before = tree.below(first, end, np.minimum(blocks + width, bound))
    upto = tree.below(first, end, np.minimum(blocks + 2 * width, bound))
    hit = upto > before
    blocks, first, end, before, upto = (x[hit] for x in (blocks, first, end, before, upto))
    count = upto - before
    nearest = tree.smallest(first, end, before)
    places, periods = [blocks[count <= 2]], [(nearest - blocks)[count <= 2]]
    two = count == 2
    places.append(blocks[two])
    periods.append(tree.smallest(first[two], end[two], before[two] + 1) - blocks[two])
    many = count > 2
    blocks, first, end, before, upto, nearest = (
        x[many] for x in (blocks, first, end, before, upto, nearest)
    )
    step = tree.smallest(first, end, before + 1) - nearest
    last = tree.smallest(first, end, upto - 1)
    own_end = blocks + classes.common(blocks, blocks + step)
    their_end = nearest + classes.common(nearest, nearest + step)
    period = their_end - own_end
    fits = (period >= nearest - blocks) & (period <= last - blocks)
    fits &= (period - (nearest - blocks)) % step == 0
    places.append(blocks[fits])
    periods.append(period[fits])
    return np.concatenate(places), np.concatenate(periods)


def found_runs(
    numbers: np.ndarray, longest: int, least_words: int, least_periods: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of the numbered words, by start, then period."""
    empty = np.zeros(0, np.int64)
    classes = Classes(numbers)
    # The last level has no two equal stretches.
    levels = [k for k in range(len(classes.levels) - 1) if least_periods << k <= longest]
    if not levels:
        return empty, empty, empty
    tree = WaveletTree(classes.order)
    starts, ends, periods = [], [], []
    for level in levels:
        place, period = candidates(classes, tree, level)
        start = place - classes.common_before(place, place + period)
        end = place + period + classes.common(place, place + period)
        long = end - start >= np.maximum(least_words, least_periods * period)
        starts.append(start[long])
        ends.append(end[long])
        periods.append(period[long])
    start, end, period = (np.concatenate(x) for x in (starts, ends, periods))
    # A multiple of a run's period gives the same stretch again: the smallest stays.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs_of(
    texts: list[bytes], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(words, runs as (start, length, period) by start and period, collapsed text) of each text.

    The collapsed text has the words outside runs and the first period of every run, joined by one
    blank; words in the first period of one run and later in another go.
    """
    documents = [words_of(raw) for raw in texts]
    numbers, firsts = numbered(documents)
    longest = max(map(len, documents), default=0)
    start, end, period = found_runs(numbers, longest, least_words, least_periods)
    change = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    kept = np.cumsum(change) == 0
    borders = np.searchsorted(start, np.append(firsts, len(numbers)))
    for row, words in enumerate(documents):
        own = slice(borders[row], borders[row + 1])
        first = int(firsts[row])
        if own.start == own.stop:
            yield len(words), [], b" ".join(words)
            continue
        runs = list(
            zip(
                (start[own] - first).tolist(), (end[own] - start[own]).tolist(), period[own].tolist()
            )
        )
        left = itertools.compress(words, kept[first : first + len(words)].tolist())
        yield len(words), runs, b" ".join(left)


def word_runs(
    docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> DataFrame:
    """All maximal periodic runs of words of every whole text, and the text without the repeats.

    One row per document: doc_id, n_words, runs (start word, length, smallest period; by start, then
    period) and collapsed, see :func:`runs_of`. A run has at least `least_words` words and
    `least_periods` periods, of which the method needs four. Null and empty texts have no words, no
    runs and an empty collapsed text. Ids may be null or repeat, other columns are not read, an empty
    table gives no rows. A task holds the words of about 2 MB of texts, or of one longer text, with one
    number per word and doubling.
    """
    if least_periods < 4:
        raise ValueError("a run must have at least four periods")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for first, data, offsets in frames.slices(texts):
                raw = data.tobytes()
                rows = [raw[a:b] for a, b in itertools.pairwise(offsets.tolist())]
                counts, runs, collapsed = zip(*runs_of(rows, least_words, least_periods))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(rows)),
                        pa.array(counts, pa.int64()),
                        pa.array(runs, RUN_LIST),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return frames.texts(docs).mapInArrow(run, RUNS)


def repeating(key: Column, text: Column) -> Column:
    """The text as the query wants it read: a tenth of the documents, by a hash of the id, repeat one
    stretch of their words up to the end; all others, and those without words or id, are as they are."""
    hashed = F.crc32(key.cast("string"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")

    def turned(words: Column) -> Column:
        n = F.size(words)
        seed = F.floor(hashed / 10)
        a = (seed % F.greatest(n, F.lit(1))).cast("int")
        p = (1 + F.floor((n - a) / (3 + seed % 8))).cast("int")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " "))

    chosen = F.get(F.transform(F.array(words), turned), F.lit(0))
    return F.when(hashed % 10 == 0, F.coalesce(chosen, F.lit(""))).otherwise(text)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = frames.table(spark, folder, "documents")
    found = word_runs(docs.withColumn("text", repeating(F.col("doc_id"), F.col("text"))))
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
            ),
        )
    )
    line = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )

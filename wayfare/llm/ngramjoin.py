"""N-gram Jaccard join by vertical partitioning, with components of linked documents.

Equal shingle sets are one node. Shingles have a global order, rare ones first: by the count of their
cell in a fixed-size count table over the whole corpus, then by number. Two sets that are similar
enough share a shingle in the first part of both, so candidates meet at these shingles only. For
candidates, the global order is cut into fragments: the common shingles of a pair are counted in each
fragment separately and summed per pair, which gives the exact similarity.

No group is expanded into all its pairs. First every node is compared with a few nodes of each shingle
it shares, then with its nearest one in another component; that joins groups of copies. At last all
pairs whose nodes are still in different components are compared, after bounds on size, place and a
bitmap of the sets, none of which can drop a link. Nodes and shingles are 64-bit hashes; everything
else is exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.llm import frames
from wayfare.llm.components import components
from wayfare.llm.shingles import mixed, set_numbers, shingle_sets, sorted_inside
from wayfare.operators.sides import bounded_side

#: Cells of the count table: fixed, whatever the corpus; it is all that every task is sent.
CELL_BITS = 20
#: Cells in one row of partial counts.
ROW_CELLS = 1 << 12
#: Nodes that the others at a shingle are compared with at first.
FIRST = 3
#: Fragments of the global order.
FRAGMENTS = 4
#: Least bits of the bitmap of a set, and bits of the folded one that blocks are compared by.
BITMAP, FOLDED = 1024, 512
#: Bytes of text whose shingles a task works out at once, and bitmaps that it counts at once.
SLICE, MAPS = 500_000, 256
#: Rows of a shingle in one block; a shingle with more is compared block by block.
BLOCK = 2000
#: The membership filter of candidate nodes has 16 bits for each, at most this many.
FILTER_BITS = 1 << 27

#: Stands for a null id.
NO_ID = -(1 << 63)
SALT = np.uint64(0x2545F4914F6CDD1D)
ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.uint8)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _sets(batch: pa.RecordBatch, words: int):
    """(first row, shingles, where each text's begin) for slices of a batch of texts."""
    for first, data, offsets in frames.slices(batch.column(1), SLICE):
        yield (first, *shingle_sets(data, offsets, words))


def _cells(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _surveyed(docs: DataFrame, words: int) -> DataFrame:
    """One pass over all texts, with two kinds of rows: of documents (doc_id, n_shingles, node, bitmap;
    node is 0 for an empty set), and of ranges of cells (cells, salt, counts), with how many shingles a
    task saw in each cell."""

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        frames.kept_by("")  # models of earlier stages are done with
        total = np.zeros(1 << CELL_BITS, np.int64)
        names = ["doc_id", "n_shingles", "node", "bitmap", "cells", "salt", "counts"]
        for batch in batches:
            for first, values, firsts in _sets(batch, words):
                total += np.bincount(_cells(values), minlength=len(total))
                sizes = np.diff(firsts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sizes)),
                        pa.array(sizes),
                        _signed(set_numbers(values, firsts)),
                        pa.array(bitmaps(values, firsts), pa.binary()),
                        *(pa.nulls(len(sizes), kind) for kind in (pa.int32(), pa.int32(), pa.binary())),
                    ],
                    names=names,
                )
        rows = total.reshape(-1, ROW_CELLS)
        used = np.flatnonzero(rows.any(axis=1))
        empty = [pa.nulls(len(used), kind) for kind in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
        salt = TaskContext.get().partitionId() % 64
        yield pa.RecordBatch.from_arrays(
            [
                *empty,
                pa.array(used.astype(np.int32)),
                pa.array(np.full(len(used), salt, np.int32)),
                pa.array([packed(rows[k]) for k in used], pa.binary()),
            ],
            names=names,
        )

    schema = (
        "doc_id long, n_shingles long, node long, bitmap binary, cells int, salt int, counts binary"
    )
    return docs.mapInArrow(survey, schema)


def packed(counts: np.ndarray) -> bytes:
    """Counts of neighbouring cells, most of them small, as a few bytes."""
    return zlib.compress(counts.astype("<i8").tobytes(), 1)


def unpacked(data) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<i8")


def _cell_order(surveyed: DataFrame) -> np.ndarray:
    """The place of every cell among all, by the count of shingles in it."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(ROW_CELLS, np.int64)
        for counts in table.column("counts"):
            total += unpacked(counts.as_buffer())
        return pa.table(
            {"cells": table.column("cells")[:1], "salt": table.column("salt")[:1], "counts": [packed(total)]},
            schema=pa.schema([("cells", pa.int32()), ("salt", pa.int32()), ("counts", pa.binary())]),
        )

    # In two steps, so that no group holds a row of every task.
    sums = surveyed.filter("cells is not null").select("cells", "salt", "counts")
    for keys in (["cells", "salt"], ["cells"]):
        sums = sums.groupBy(*keys).applyInArrow(add, "cells int, salt int, counts binary")
    found = sums.toArrow()  # at most 2 ** CELL_BITS counts
    total = np.zeros((1 << CELL_BITS) // ROW_CELLS * ROW_CELLS, np.int64).reshape(-1, ROW_CELLS)
    for cells, counts in zip(found.column("cells").to_pylist(), found.column("counts").to_pylist()):
        total[cells] = unpacked(counts)
    order = np.empty(total.size, np.uint32)
    order[np.argsort(total.ravel(), kind="stable")] = np.arange(total.size, dtype=np.uint32)
    return order


def _placed(values: np.ndarray, firsts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Shingles renumbered by the place of their cell, so that the global order is that of numbers;
    ascending inside each text."""
    low = values & np.uint64((1 << (64 - CELL_BITS)) - 1)
    place = order[_cells(values)].astype(np.uint64)
    return sorted_inside(place << np.uint64(64 - CELL_BITS) | low, firsts)


def _prefixes(docs: DataFrame, words: int, percent: int, shared) -> DataFrame:
    """The first shingles of every set in the global order: key, node, n (set size), place.

    A set of n that is similar to another shares at least ceil(n * percent / 100) shingles with it,
    so one of the first n - that + 1.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for _, values, firsts in _sets(batch, words):
                sizes = np.diff(firsts)
                nodes = set_numbers(values, firsts)
                fresh = np.zeros(len(sizes), bool)
                for k, node in enumerate(nodes.tolist()):
                    if sizes[k] and node not in seen:
                        seen.add(node)
                        fresh[k] = True
                values = _placed(values, firsts, shared.value)
                front = np.where(fresh, sizes - (percent * sizes + 99) // 100 + 1, 0)
                at = frames.ranges(firsts[:-1], firsts[:-1] + front)
                owner = np.repeat(np.arange(len(sizes)), front)
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(values[at]),
                        _signed(nodes[owner]),
                        pa.array(sizes[owner].astype(np.int32)),
                        pa.array((at - firsts[owner]).astype(np.int32)),
                    ],
                    names=["key", "node", "n", "place"],
                )

    return docs.mapInArrow(cut, "key long, node long, n int, place int")


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The common shingles that two sets of these sizes need to be linked."""
    both = percent * (a.astype(np.int64) + b)
    return -(-both // (100 + percent))


def possible(n_a, place_a, n_b, place_b, percent: int) -> np.ndarray:
    """Whether sizes and places leave room for a link.

    At their first common shingle, what is behind it in the shorter rest and it are all they can
    share; a later common shingle only leaves less, so no link is dropped at its first one.
    """
    low, high = np.minimum(n_a, n_b).astype(np.int64), np.maximum(n_a, n_b).astype(np.int64)
    room = 1 + np.minimum(n_a - place_a, n_b - place_b) - 1
    return (100 * low >= percent * high) & (room >= least_overlap(n_a, n_b, percent))


def _met(prefixes: DataFrame, percent: int) -> DataFrame:
    """Rows at shingles of several nodes, each with up to FIRST nodes to be compared with.

    Rows of a shingle come in an order of hashed nodes, so the first ones are as good as random, and
    the same for other shingles of the same nodes. Rows stream by; only the first ones are held.
    """
    others = ", ".join(f"other{k} long" for k in range(FIRST))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the rows of the last key that may still be wanted, and how many went before
        for batch in batches:
            own = [batch.column(k).to_numpy() for k in range(4)]
            gone = 0
            if held is not None:
                own = [np.concatenate([before, now]) for before, now in zip(held[0], own)]
                gone = held[1]
            key, node, n, place = own
            repeated = np.zeros(len(key), bool)
            repeated[1:] = (key[1:] == key[:-1]) & (node[1:] == node[:-1])
            key, node, n, place = (column[~repeated] for column in own)
            if not len(key):
                continue
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            run = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(key))))
            inside = np.arange(len(key)) - start[run]
            last = run == len(start) - 1
            # Rows that went out before are only there to be compared with.
            sent = (run == 0) & (inside < gone)
            alone = np.bincount(run)[run] == 1
            # A last row that is alone so far waits for the next batch.
            out = np.flatnonzero(~sent & ~alone)
            columns = [key[out], node[out], n[out], place[out]]
            for k in range(FIRST):
                at = np.minimum(start[run[out]] + k, len(key) - 1)
                fits = (inside[out] > k) & possible(n[at], place[at], n[out], place[out], percent)
                columns.append(np.ma.array(node[at], mask=~fits))
            if len(out):
                yield pa.RecordBatch.from_arrays(
                    [
                        *map(pa.array, columns[:4]),
                        *(pa.array(column.data, mask=column.mask) for column in columns[4:]),
                    ],
                    names=["key", "node", "n", "place", *(f"other{k}" for k in range(FIRST))],
                )
            tail = np.flatnonzero(last)
            # The first rows of the last key, and its very last row to see a repeated node.
            kept = tail[:FIRST] if len(tail) <= FIRST else np.append(tail[:FIRST], tail[-1])
            kept_out = 0 if alone[tail[0]] else len(kept)
            held = ([column[kept] for column in (key, node, n, place)], kept_out)

    # The order is worked out behind the shuffle, so that it is not sent.
    dealt = prefixes.repartition("key").withColumn("__order", F.xxhash64("node"))
    dealt = dealt.sortWithinPartitions("key", "__order", "node").drop("__order")
    return dealt.mapInArrow(meet, f"key long, node long, n int, place int, {others}")


def _filter_places(nodes: np.ndarray, ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the membership filter for each node with its document."""
    both = nodes + mixed(ids ^ SALT)
    found = (mixed(both), mixed(both ^ SALT))
    return tuple((hashes & np.uint64(bits - 1)).astype(np.int64) for hashes in found)


def _filter_of(nodes: DataFrame) -> np.ndarray:
    """The membership filter of (node, doc) rows, as words of 32 bits."""
    count = nodes.count()
    bits = 1 << max(16, min(FILTER_BITS, 16 * max(count, 1)).bit_length() - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = (_unsigned(batch.column(0)), _unsigned(batch.column(1)))
            at = np.concatenate(_filter_places(*own, bits))
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> 5).astype(np.int32)), pa.array(np.int64(1) << (at & 31))],
                names=["word", "bits"],
            )

    words = nodes.mapInArrow(place, "word int, bits long").groupBy("word")
    found = words.agg(F.bit_or("bits").alias("bits")).toArrow()  # at most FILTER_BITS / 32 rows
    table = np.zeros(bits // 32, np.uint32)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return table


def _segments(docs: DataFrame, words: int, nodes: DataFrame, shared) -> DataFrame:
    """node, doc, fragment and part (its shingles there, ascending) of the given (node, doc) rows, and
    of a few others that the filter lets through."""
    asked = docs.sparkSession.sparkContext.broadcast(_filter_of(nodes))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = asked.value, set()
        for batch in batches:
            ids = pc.fill_null(batch.column(0), NO_ID)
            for first, values, firsts in _sets(batch, words):
                found = set_numbers(values, firsts)
                own_ids = _unsigned(ids.slice(first, len(found)))
                kept = found != 0
                for at in _filter_places(found, own_ids, len(known) * 32):
                    kept &= (known[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1
                rows = []
                for k in np.flatnonzero(kept):
                    node, doc = int(found[k]), int(own_ids[k])
                    if (node, doc) in seen:
                        continue
                    seen.add((node, doc))
                    own = values[firsts[k] : firsts[k + 1]]
                    own = _placed(own, np.array([0, len(own)]), shared.value)
                    cuts = np.searchsorted(own >> np.uint64(62), np.arange(FRAGMENTS + 1))
                    for part in range(FRAGMENTS):
                        piece = own[cuts[part] : cuts[part + 1]].tobytes()
                        rows.append((node, doc, part, piece))
                if rows:
                    own_nodes, own_docs, parts, pieces = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            _signed(np.array(own_nodes, np.uint64)),
                            _signed(np.array(own_docs, np.uint64)),
                            pa.array(parts, pa.int32()),
                            pa.array(pieces, pa.binary()),
                        ],
                        names=["node", "doc", "fragment", "part"],
                    )

    return frames.written(docs.mapInArrow(cut, "node long, doc long, fragment int, part binary"))


def bitmaps(values: np.ndarray, firsts: np.ndarray) -> list[bytes]:
    """Of every set; bit k is the parity of the shingles that fall on it: two sets differ in at least
    as many shingles as their bitmaps differ in bits.

    A bitmap has at least as many bits as its set has shingles, so that it tells long sets apart as
    well. The number of bits is a power of two: folded(), a bitmap is that of fewer bits.
    """
    out: list[bytes] = []
    for first in range(0, len(firsts) - 1, MAPS):
        own = firsts[first : first + MAPS + 1]
        sizes = np.diff(own)
        bits = np.array([max(BITMAP, 1 << (n - 1).bit_length() if n else 0) for n in sizes.tolist()])
        starts = np.concatenate([[0], np.cumsum(bits)])
        at = (values[own[0] : own[-1]] & np.repeat((bits - 1).astype(np.uint64), sizes)).astype(np.int64)
        at += np.repeat(starts[:-1], sizes)
        odd = (np.bincount(at, minlength=starts[-1]) & 1).astype(np.uint8)
        raw, ends = np.packbits(odd).tobytes(), (starts // 8).tolist()
        out += [raw[low:high] for low, high in zip(ends, ends[1:])]
    return out


def folded(maps: list[bytes], size: int) -> np.ndarray:
    """The bitmaps in rows of `size` bytes each, which none of them may fall short of."""
    short = [
        each if len(each) == size
        else np.bitwise_xor.reduce(np.frombuffer(each, np.uint8).reshape(-1, size)).tobytes()
        for each in maps
    ]
    return np.frombuffer(b"".join(short), np.uint8).reshape(len(maps), size)


def differing(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """In how many bits the bitmaps of each pair differ, at the width of the shorter one."""
    sizes = np.array([min(len(a), len(b)) for a, b in zip(left, right)], np.int64)
    out = np.zeros(len(sizes), np.int64)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        each = max(1, (BITMAP // 8) * 4096 // size)
        for at in (rows[k : k + each] for k in range(0, len(rows), each)):
            own = (folded([side[k] for k in at.tolist()], size) for side in (left, right))
            out[at] = ONES[np.bitwise_xor(*own)].sum(axis=1, dtype=np.int64)
    return out


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may be links by their bitmaps, with sizes and documents: a, n_a, doc_a,
    b, n_b, doc_b."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column(1).to_numpy(), batch.column(4).to_numpy()
            differ = differing(batch.column(6).to_pylist(), batch.column(7).to_pylist())
            kept = differ <= n_a.astype(np.int64) + n_b - 2 * least_overlap(n_a, n_b, percent)
            left = batch.filter(pa.array(kept))
            yield pa.RecordBatch.from_arrays(left.columns[:6], names=left.schema.names[:6])

    for end in ("a", "b"):
        own = nodes.select(
            F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("doc").alias(f"doc_{end}"),
            F.col("bitmap").alias(f"map_{end}"),
        )
        pairs = pairs.join(own, end)
    pairs = pairs.select("a", "n_a", "doc_a", "b", "n_b", "doc_b", "map_a", "map_b")
    return pairs.mapInArrow(
        compare, "a long, n_a int, doc_a long, b long, n_b int, doc_b long"
    )


def _bits(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _linked(pairs: DataFrame, docs: DataFrame, words: int, percent: int, shared) -> DataFrame:
    """The pairs of _likely() that are links, by partial overlaps summed over fragments; written."""
    ends = pairs.select(F.col("a").alias("node"), F.col("doc_a").alias("doc")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("doc_b").alias("doc"))
    )
    segments = _segments(docs, words, ends.distinct(), shared)

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [
                len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), True))
                for x, y in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(counts, pa.int64())],
                names=["a", "n_a", "b", "n_b", "fragment", "common"],
            )

    left = segments.select(
        F.col("node").alias("a"), F.col("doc").alias("doc_a"), "fragment", F.col("part").alias("part_a")
    )
    right = segments.select(
        F.col("node").alias("b"), F.col("doc").alias("doc_b"), "fragment", F.col("part").alias("part_b")
    )
    joined = pairs.join(left, ["a", "doc_a"]).join(right, ["b", "doc_b", "fragment"])
    partial = joined.select("a", "n_a", "b", "n_b", "fragment", "part_a", "part_b").mapInArrow(
        overlap, "a long, n_a int, b long, n_b int, fragment int, common long"
    )
    # A document that is repeated as a whole gives the same partial count again.
    each = [F.max(F.when(F.col("fragment") == k, F.col("common"))) for k in range(FRAGMENTS)]
    total = partial.groupBy("a", "n_a", "b", "n_b").agg(
        *(own.alias(f"c{k}") for k, own in enumerate(each))
    )
    common = sum((F.coalesce(f"c{k}", F.lit(0)) for k in range(FRAGMENTS)), F.lit(0))
    union = F.col("n_a") + F.col("n_b") - common
    found = frames.written(total.filter(common * 100 >= union * percent).select("a", "b"))
    frames.removed(segments)
    return found


def _crowded(met: DataFrame) -> DataFrame:
    """The rows of shingles with more nodes than were compared one by one, with the number of blocks.

    A shingle is left out if all its nodes have one and the same such shingle next before it: then every
    pair of them meets there already, and only the first common shingle of a pair matters. So of a
    passage that many documents share, few shingles stay.
    """
    counts = met.groupBy("key").agg(F.count("*").alias("__n")).filter(F.col("__n") > FIRST + 1)
    counts = counts.select("key", F.ceil(F.col("__n") / BLOCK).cast("int").alias("blocks"))
    before = F.lag("key").over(Window.partitionBy("node").orderBy("place"))
    rows = met.select("key", "node", "n", "place").join(counts, "key").withColumn("__before", before)
    rows = frames.written(rows)
    covered = rows.groupBy("key").agg(
        F.count("*").alias("__n"), F.count("__before").alias("__m"),
        F.min("__before").alias("__low"), F.max("__before").alias("__high"),
    )
    covered = covered.filter("__m = __n and __low = __high").select("key")
    kept = frames.written(rows.join(covered, "key", "left_anti").drop("__before"))
    frames.removed(rows)
    return kept


def _across(
    crowded: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int, nearest: bool
) -> DataFrame:
    """Pairs (a, b) at a shingle whose nodes are in different components and may be links: all of
    them, or for each node only the one whose bitmap is nearest."""
    rows = crowded.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rows = frames.written(rows)
    # Shingles whose nodes are all in one component are done.
    open_keys = rows.groupBy("key").agg(F.min("label").alias("__low"), F.max("label").alias("__high"))
    open_keys = open_keys.filter("__low <> __high").select("key")
    rows = rows.join(open_keys, "key", "left_semi").join(_short(nodes), "node")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # A row meets every block of its shingle once: in the blocks (own, j) and (j, own).
    rows = rows.withColumn("__j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "key", "node", "n", "place", "label", "bitmap", "own",
        F.least("own", "__j").alias("low"), F.greatest("own", "__j").alias("high"),
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            table = pa.Table.from_batches([*waiting, batch]).combine_chunks()
            new = _borders(table)
            if len(new):  # all but the last block are complete
                yield from _pairs_of(table.slice(0, new[-1]), percent, nearest)
                waiting = table.slice(new[-1]).to_batches()
            else:
                waiting = table.to_batches()
        if waiting:
            yield from _pairs_of(pa.Table.from_batches(waiting).combine_chunks(), percent, nearest)

    dealt = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def _short(nodes: DataFrame) -> DataFrame:
    """node and bitmap, folded to one width: it differs in no more bits than the whole, which _likely()
    looks at."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = folded(batch.column(1).to_pylist(), FOLDED // 8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([row.tobytes() for row in rows], pa.binary())],
                names=["node", "bitmap"],
            )

    return nodes.select("node", "bitmap").mapInArrow(fold, "node long, bitmap binary")


def _borders(table: pa.Table) -> np.ndarray:
    """Where a new block begins."""
    names = [table.column(k).to_numpy() for k in (0, 7, 8)]
    return np.flatnonzero(np.logical_or.reduce([name[1:] != name[:-1] for name in names])) + 1


def _pairs_of(table: pa.Table, percent: int, nearest: bool) -> Iterator[pa.RecordBatch]:
    """The pairs of whole blocks."""
    if not table.num_rows:
        return
    node, n, place, label, own, low, high = (table.column(k).to_numpy() for k in (1, 2, 3, 4, 6, 7, 8))
    maps = _bits(table.column(5).combine_chunks())
    new = _borders(table)
    out: list[np.ndarray] = []
    for first, last in zip([0, *new], [*new, len(node)]):
        if (label[first:last] == label[first]).all():
            continue
        block = np.arange(first, last)
        same = low[first] == high[first]
        others = block if same else block[own[block] == high[first]]
        for at in block if same else block[own[block] == low[first]]:
            b = others[others > at] if same and not nearest else others
            b = b[label[b] != label[at]]
            b = b[possible(n[at], place[at], n[b], place[b], percent)]
            if not len(b):
                continue
            differ = ONES[maps[b] ^ maps[at]].sum(axis=1, dtype=np.int64)
            near = differ <= n[at] + n[b] - 2 * least_overlap(n[b], n[at], percent)
            b = b[near]
            if len(b) and nearest:
                b = b[[differ[near].argmin()]]
            if len(b):
                out.append(np.stack([np.full(len(b), node[at]), node[b]]))
    if out:
        found = np.concatenate(out, axis=1)
        found = np.unique(np.sort(found, axis=0), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, and node (the number of its set, 0 if
    that is empty).

    Two documents are linked if 100 * common >= percent * union of their sets of distinct `words`-word
    shingles; a text of fewer words is one shingle. component_id is the least doc_id reached by
    links, the document's own included. Null texts and texts without words have no shingles and are
    linked with nothing. Equal texts are linked; ids may be null (then never a component id, unless
    all of a component are) or repeat. Other columns are not read.
    """
    docs = frames.texts(docs)
    surveyed = frames.written(_surveyed(docs, words))
    shared = docs.sparkSession.sparkContext.broadcast(_cell_order(surveyed))
    numbered = surveyed.filter("cells is null")
    nodes = numbered.filter("node <> 0").groupBy("node").agg(
        F.first("n_shingles").cast("int").alias("n"),
        F.first("bitmap").alias("bitmap"),
        F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("doc"),
    )
    met = frames.written(_met(_prefixes(docs, words, percent, shared), percent))
    nodes = frames.written(nodes.join(met.select("node").distinct(), "node", "left_semi"))
    first = met.select(
        "node", F.explode(F.array(*(f"other{k}" for k in range(FIRST)))).alias("other")
    ).filter("other is not null")
    first = first.select(
        F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")
    ).distinct()
    first = frames.written(_likely(first, nodes, percent))
    links = _linked(first, docs, words, percent, shared)
    crowded = _crowded(met)
    for done in (first, met):
        frames.removed(done)
    for nearest in (True, False):
        labels = frames.written(components(links))
        across = frames.written(_likely(_across(crowded, labels, nodes, percent, nearest), nodes, percent))
        if across.isEmpty():
            continue
        more = _linked(across, docs, words, percent, shared)
        stars = labels.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
        found = frames.written(stars.unionByName(more))
        for done in (links, labels, across, more):
            frames.removed(done)
        links = found
    for done in (crowded, nodes):
        frames.removed(done)
    tops = components(links).select("node", F.col("label").alias("__top"))
    placed = numbered.select("doc_id", "n_shingles", "node").join(tops, "node", "left").withColumn(
        "__top", F.when(F.col("node") != 0, F.coalesce("__top", "node"))
    )
    least = placed.filter("__top is not null").groupBy("__top").agg(
        F.min("doc_id").alias("component_id")
    )
    return placed.join(least, "__top", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("node") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "node",
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without all but one of every component: the one with the least id stays.

    Documents without shingles all stay. Of rows that repeat the id and the shingles of the one that
    stays, one stays. Null ids go if their component has another id. Columns are as they were.
    """
    found = frames.written(near_duplicates(docs, words, percent).filter("node <> 0"))
    found = found.withColumn("__stays", F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = found.filter("not __stays").select("doc_id", "node").distinct()
    repeated = found.filter("__stays").groupBy("doc_id", "node").count().filter("count > 1")
    numbered = _with_node(docs, words)

    def apart(side: DataFrame, how: str) -> DataFrame:
        side = bounded_side(side.select(F.col("doc_id").alias("__id"), F.col("node").alias("__node")))
        same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("node") == F.col("__node"))
        return numbered.join(side, same, how)

    if repeated.isEmpty():
        return apart(gone, "left_anti").select("row.*")
    once = apart(gone.unionByName(repeated.select("doc_id", "node")), "left_anti")
    nth = F.row_number().over(Window.partitionBy("doc_id", "node").orderBy(F.xxhash64("row")))
    again = apart(repeated, "left_semi").withColumn("__nth", nth).filter("__nth = 1")
    return once.select("row.*").unionByName(again.select("row.*"))


def _with_node(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, node and row of the documents. The text is only sent once, inside the row."""
    frames.importable(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1).field("text").cast(pa.string()), "")
            nodes = [
                set_numbers(*shingle_sets(data, offsets, words))
                for _, data, offsets in frames.slices(texts, SLICE)
            ]
            nodes = np.concatenate(nodes) if nodes else np.zeros(0, np.uint64)
            yield frames.carried(batch, [batch.column(0), _signed(nodes)], ["doc_id", "node"])

    return rows.mapInArrow(number, frames.carrying("doc_id long, node long", rows))


SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + least(5, len(w)) - 1), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS p
          FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * c >= 80 * (a.n + b.n - c)
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, l.y FROM reached r JOIN links l ON r.other = l.x
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(frames.table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")

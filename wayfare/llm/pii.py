"""Personal data: high-recall candidates, boosted trees over format and context, calibrated cuts.

Base spans of four kinds are found by fixed rules and always stay. Generators then propose further,
overlapping spans (written-out or bracketed addresses, digit groups of any layout). Boosted trees
score each proposal; those that reach the cut of their kind and lie in no other span are added.

The trees learn from the corpus itself, from all proposals of all documents. Equal proposals are counted
as one cell, and the trees grow from sums over the cells, one job a level. Positive are those that a base
span of their kind confirms, and the same spans rewritten in their context into forms that the fixed rules
do not know (written-out or bracketed addresses, phone numbers without a plus sign);
negative are proposals that touch no base span of their kind. Features are hidden at random while
learning, so that no single format mark is all that a tree looks at. The cuts are set on rewritten and
negative proposals of documents that were not learned from, so that added spans keep a stated precision.
"""

from __future__ import annotations

import bisect
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import frames
from wayfare.llm.spans import Span, digest, in_code_points, listed

# The kinds in their order.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Starting behind a digit is never needed and would try every digit of a long run.
ADDRESS = re.compile(rb"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD_DIGITS = re.compile(rb"[0-9](?:[\x20-]?[0-9])++")
PHONE_DIGITS = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
NO_DIGITS = bytes(byte for byte in range(256) if not 0x30 <= byte <= 0x39)
ANY_DIGIT = re.compile(rb"[0-9]")

#: Precision that the cut of each kind keeps on the documents not learned from.
PRECISION = 0.98
#: Scores are told apart in steps of 1 / LEVELS when a cut is set.
LEVELS = 1 << 12
#: A feature is cut into at most this many places.
PLACES = 32
#: Gradients are whole multiples of 1 / UNIT, so that sums do not depend on the order of tasks.
UNIT = 1 << 20
#: Sets of features that are hidden together.
MASKS = 256
#: Copies of cells that a task sums up, and tasks whose sums go straight to the driver.
TASK_CELLS = 1 << 14
TOGETHER = 64


def luhn(digits: bytes) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        digit -= 0x30
        if place % 2:
            digit = digit * 2 - 9 if digit > 4 else digit * 2
        total += digit
    return total % 10 == 0


def emails(raw: bytes) -> list[Span]:
    """Leftmost non-overlapping addresses, found from their @ signs."""
    found, done, before = [], 0, 0
    at = raw.find(b"@")
    while at >= 0:
        low = max(done, before)
        start = low + len(raw[low:at].rstrip(LOCAL))
        if start < at and (match := DOMAIN.match(raw, at + 1)):
            done = match.end()
            found.append((start, done, EMAIL))
        before = at + 1
        at = raw.find(b"@", before)
    return found


def small_parts(address: bytes) -> bool:
    parts = [part.lstrip(b"0") for part in address.split(b".")]
    return all(len(part) <= 3 and int(part or b"0") <= 255 for part in parts)


def base_spans(raw: bytes) -> list[Span]:
    """The spans of the fixed rules, as byte spans; matches that fail a check are dropped."""
    found = emails(raw)
    if not ANY_DIGIT.search(raw):
        return found
    for match in ADDRESS.finditer(raw):
        if small_parts(match[0]):
            found.append((*match.span(), IP))
    for match in CARD_DIGITS.finditer(raw):
        digits = match[0].translate(None, NO_DIGITS)
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((*match.span(), CARD))
    if b"+" in raw:
        for match in PHONE_DIGITS.finditer(raw):
            if 10 <= len(match[0].translate(None, NO_DIGITS)) <= 15:
                found.append((*match.span(), PHONE))
    return found


# Generators. Bounded repeats keep each try short.
WRITTEN_AT = re.compile(
    rb"@|\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20(?=[A-Za-z0-9-]{1,63}\x20dot\x20)", re.IGNORECASE
)
#: Without one of these a text holds no written address.
AT_MARKS = (b"@", b"[", b"(", b"{", b" dot ", b" Dot ", b" DOT ")
WRITTEN_DOMAIN = re.compile(
    rb"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63}){0,6}",
    re.IGNORECASE,
)
GROUPS = re.compile(rb"(?<![0-9])[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,23}(?![0-9])")
DOTTED = re.compile(rb"(?<![0-9])[0-9]{1,5}(?:\x20?[\[(]?\.[\])]?\x20?[0-9]{1,5}){3}(?![0-9])")


def proposals(raw: bytes) -> list[Span]:
    """Overlapping candidates of every kind, as byte spans."""
    found = []
    for match in WRITTEN_AT.finditer(raw) if any(mark in raw for mark in AT_MARKS) else ():
        low = max(0, match.start() - 64)
        start = low + len(raw[low : match.start()].rstrip(LOCAL))
        after = WRITTEN_DOMAIN.match(raw, match.end())
        if start < match.start() and after:
            found.append((start, after.end(), EMAIL))
    if ANY_DIGIT.search(raw):
        for match in DOTTED.finditer(raw):
            found.append((*match.span(), IP))
        for match in GROUPS.finditer(raw):
            found.append((*match.span(), CARD))
            found.append((*match.span(), PHONE))
    return found


def rewritten(raw: bytes, spans: list[Span]) -> tuple[bytes, list[Span]]:
    """The text with its spans in forms that the fixed rules do not find, and the new spans.

    The form is chosen by a hash of the span; of overlapping spans the first is rewritten."""
    out, found, done, size = [], [], 0, 0
    for start, end, kind in sorted(spans):
        if start < done:
            continue
        own, form = raw[start:end], zlib.crc32(raw[start:end]) % 4
        if kind == EMAIL:
            at = (b" [at] ", b" at ", b"(at)", b" (at) ")[form]
            dot = (b" [dot] ", b" dot ", b".", b" (dot) ")[form]
            name, _, host = own.rpartition(b"@")
            own = name + at + host.replace(b".", dot)
        elif kind == IP:
            dot = (b"[.]", b" . ", b"(.)", b" [.] ")[form]
            own = own.replace(b".", dot)
        elif kind == CARD:
            digits = own.translate(None, NO_DIGITS)
            own = (b".", b"/", b"--", b"  ")[form].join(digits[k : k + 4] for k in range(0, len(digits), 4))
        else:
            own = own.removeprefix(b"+")
            own = (own, re.sub(rb"[^0-9]+", b" ", own), re.sub(rb"[^0-9]+", b"-", own), own)[form]
        out += [raw[done:start], own]
        size += start - done
        found.append((size, size + len(own), kind))
        size, done = size + len(own), end
    return b"".join(out) + raw[done:], found


HINTS = {
    EMAIL: re.compile(rb"mail|contact|write|courriel|correo", re.IGNORECASE),
    IP: re.compile(rb"\bip\b|host|server|addr|node", re.IGNORECASE),
    CARD: re.compile(rb"card|visa|credit|kart|tarjeta|carte|pay", re.IGNORECASE),
    PHONE: re.compile(rb"phone|tel|call|fax|mobil|cell|\bnum", re.IGNORECASE),
}
RUN = re.compile(rb"[0-9]+")


def _class(byte: int | None) -> int:
    if byte is None:
        return 0
    shown = bytes([byte])
    return 1 if shown.isspace() else 2 if shown.isalpha() else 3 if shown.isdigit() else 4


def features(raw: bytes, span: Span) -> list[float]:
    """Format and context of a proposal."""
    start, end, kind = span
    own = raw[start:end]
    digits = own.translate(None, NO_DIGITS)
    groups = [len(group) for group in RUN.findall(own)]
    before = raw[max(0, start - 32) : start]
    written = own.lower()
    tail = re.split(rb"[^A-Za-z0-9-]+", own)[-1]
    return [
        kind,
        end - start,
        len(digits),
        sum(map(bytes.isalpha, (own[k : k + 1] for k in range(len(own))))),
        len(groups),
        max(groups, default=0),
        min(groups, default=0),
        groups[0] if groups else 0,
        groups[-1] if groups else 0,
        own.count(b"."),
        own.count(b"-"),
        own.count(b" "),
        own.count(b"(") + own.count(b"["),
        written[:1] == b"+",
        b"@" in own,
        luhn(digits) if digits else 0,
        kind == IP and all(int(group or b"0") <= 255 for group in RUN.findall(own)),
        len(tail) if tail.isalpha() else 0,
        bool(HINTS[kind].search(before)),
        _class(raw[start - 1] if start else None),
        _class(raw[end] if end < len(raw) else None),
    ]


#: Features of a proposal.
WIDTH = len(features(b"0", (0, 1, IP)))


class Tree(NamedTuple):
    """A full binary tree in arrays: per inner node a feature and a cut, per leaf a value."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def reached(self, rows: np.ndarray, level: int) -> np.ndarray:
        """The number, within the level, of the node that each row comes to."""
        node = np.zeros(len(rows), np.int64)
        for _ in range(level):
            right = rows[np.arange(len(rows)), self.feature[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return node - (2**level - 1)

    def values(self, rows: np.ndarray) -> np.ndarray:
        return self.leaf[self.reached(rows, int(np.log2(len(self.leaf))))]


class Boosted(NamedTuple):
    trees: list[Tree]
    start: float
    rate: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        for tree in self.trees:
            total += self.rate * tree.values(rows)
        return 1 / (1 + np.exp(-total))


#: Of the trees so far, the tree that grows and its level: gradients and hessians in units, by node of the
#: level, feature and place.
Sums = Callable[[Boosted, Tree, int], np.ndarray]


def _grown(sums: Callable[[Tree, int], np.ndarray], depth: int, ridge: float = 1.0) -> Tree:
    """One tree by second-order gain; its cuts are numbers of places."""
    tree = Tree(np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf), np.zeros(2**depth))
    for level in range(depth):
        gradient, hessian = sums(tree, level) / UNIT
        for node, (g, h) in enumerate(zip(gradient, hessian)):
            at = 2**level - 1 + node
            g_all, h_all = g[0].sum(), h[0].sum()
            g_right, h_right = (x[0].sum() - np.cumsum(x, axis=1)[:, :-1] for x in (g, h))
            gain = (
                g_right**2 / (h_right + ridge)
                + (g_all - g_right) ** 2 / (h_all - h_right + ridge)
                - g_all**2 / (h_all + ridge)
            )
            best, right = np.unravel_index(gain.argmax(), gain.shape), (0.0, 0.0)
            if gain[best] > 1e-6:
                tree.feature[at], tree.cut[at] = best
                right = g_right[best], h_right[best]
            if level == depth - 1:
                tree.leaf[2 * node] = -(g_all - right[0]) / (h_all - right[1] + ridge)
                tree.leaf[2 * node + 1] = -right[0] / (right[1] + ridge)
    return tree


def boosted(
    sums: Sums, share: float, cuts: list[np.ndarray], rounds: int = 40, depth: int = 3, rate: float = 0.3
) -> Boosted:
    """Logistic boosting from sums over rows, of which `share` are positive."""
    share = float(np.clip(share, 1e-3, 1 - 1e-3))
    grown = Boosted([], float(np.log(share / (1 - share))), rate)
    for _ in range(rounds):
        grown.trees.append(_grown(partial(sums, grown), depth))
    values = [np.append(own, np.inf) for own in cuts]
    return grown._replace(
        trees=[
            tree._replace(
                cut=np.array(
                    [values[k][int(cut)] if np.isfinite(cut) else cut for k, cut in zip(tree.feature, tree.cut)]
                )
            )
            for tree in grown.trees
        ]
    )


def placed(rows: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Per value the number of cuts below it."""
    return np.stack([np.searchsorted(own, rows[:, k], "left") for k, own in enumerate(cuts)], axis=1)


def hidden(rows: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Three copies of the rows one after another, two with a quarter of the values hidden (-1)."""
    chosen = np.random.default_rng(7).random((MASKS, rows.shape[1])) < 0.25
    chosen[:, 0] = False
    return np.vstack([rows, *(np.where(chosen[(mask + far) % MASKS], -1, rows) for far in (0, MASKS // 2))])


def block_sums(
    rows: np.ndarray, marks: np.ndarray, weights: np.ndarray, grown: Boosted, tree: Tree, level: int
) -> np.ndarray:
    """What a block of rows of places adds to the sums."""
    chances = grown.scores(rows)
    node = tree.reached(rows, level) * PLACES
    size = (2**level, PLACES)
    return np.stack(
        [
            np.stack(
                [np.bincount(node + own, units, size[0] * size[1]).reshape(size) for own in rows.T], axis=1
            )
            for units in (
                np.rint((chances - marks) * UNIT) * weights,
                np.rint(chances * (1 - chances) * UNIT) * weights,
            )
        ]
    ).astype(np.int64)


def cuts_of(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Quantiles of counted values, as many as there are places less one, each once."""
    order = np.argsort(values, kind="stable")
    upto = np.cumsum(counts[order])
    steps = np.linspace(0, 1, PLACES + 1)[1:-1] * upto[-1]
    return np.unique(values[order][np.searchsorted(upto, steps)])


def boost(
    rows: np.ndarray, marks: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3
) -> Boosted:
    """The trees of rows that are held here."""
    copies, marks = hidden(rows, np.arange(len(rows)) % MASKS), np.tile(marks, 3).astype(float)
    ones = np.ones(len(copies))
    cuts = [cuts_of(own, ones) for own in copies.T]
    sums = partial(block_sums, placed(copies, cuts), marks, ones)
    return boosted(sums, marks.mean(), cuts, rounds, depth, rate)


class Model(NamedTuple):
    """Trees and the cut of each kind; without trees, only base spans are found."""

    trees: Boosted | None
    cuts: tuple[float, ...]


class Nearby:
    """Spans sorted by start, to look up those that overlap another; spans of a kind are disjoint."""

    def __init__(self, spans: list[Span]):
        self.by_kind = [sorted(span for span in spans if span[2] == kind) for kind in range(len(KINDS))]

    def overlapping(self, span: Span, kind: int) -> Iterator[Span]:
        own = self.by_kind[kind]
        at = max(0, bisect.bisect_left(own, (span[0],)) - 1)
        while at < len(own) and own[at][0] < span[1]:
            if own[at][1] > span[0]:
                yield own[at]
            at += 1

    def touched(self, span: Span) -> bool:
        return any(True for kind in range(len(KINDS)) for _ in self.overlapping(span, kind))

    def confirms(self, span: Span) -> bool:
        """A span of its kind shares at least nine tenths of the common extent."""
        return any(
            10 * (min(end, span[1]) - max(start, span[0]))
            >= 9 * (max(end, span[1]) - min(start, span[0]))
            for start, end, _ in self.overlapping(span, span[2])
        )


def cells(docs: DataFrame) -> DataFrame:
    """All proposals that are learned from (learn) or that set the cuts: n of them have the features `row`
    (16 bits each), the mark and the number of hidden features `mask`."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames.kept_by("")  # models of earlier stages are done with
        for batch in frames.shorter(batches):
            found = Counter()
            for doc_id, raw in zip(batch.column(0).to_pylist(), frames.raw_column(batch.column(1))):
                learn = (doc_id or 0) % 3 != 0
                base = base_spans(raw)
                near = Nearby(base)
                again, spans = rewritten(raw, base) if base else (raw, [])
                forms = Nearby(spans)
                described = [
                    (raw, span, near.confirms(span))
                    for span in proposals(raw)
                    # What touches a base span of its kind without being it may be right or wrong. Of the
                    # documents that are not learned from, only what a base span does not find.
                    if near.confirms(span) and learn or not any(near.overlapping(span, span[2]))
                ] + [
                    (again, span, forms.confirms(span))
                    for span in (proposals(again) if spans else ())
                    if forms.confirms(span)
                    or forms.touched(span) and not any(forms.overlapping(span, span[2]))
                ]
                for text, span, mark in described:
                    around = text[max(0, span[0] - 8) : span[1] + 8]
                    row = np.array(features(text, span), np.int16).tobytes()
                    found[row, mark, learn, zlib.crc32(around) % MASKS if learn else 0] += 1
            columns = list(zip(*found)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.binary()),
                    pa.array(columns[1], pa.bool_()),
                    pa.array(columns[2], pa.bool_()),
                    pa.array(columns[3], pa.int32()),
                    pa.array(found.values(), pa.int64()),
                ],
                names=["row", "mark", "learn", "mask", "n"],
            )

    found = frames.texts(docs).mapInArrow(describe, "row binary, mark boolean, learn boolean, mask int, n long")
    return found.groupBy("row", "mark", "learn", "mask").agg(F.sum("n").alias("n"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(rows, marks, weights, masks) of the cells."""
    for batch in batches:
        if batch.num_rows:
            rows = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int16).reshape(-1, WIDTH)
            marks, masks, weights = (
                batch.column(batch.schema.names.index(name)).to_numpy(zero_copy_only=False)
                for name in ("mark", "mask", "n")
            )
            yield rows.astype(np.int64), marks.astype(float), weights, masks


def _counted(known: DataFrame) -> list[np.ndarray]:
    """The cuts of each feature, from all its values and how often each occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for rows, _, weights, masks in _blocks(batches):
            copies, weights = hidden(rows, masks), np.tile(weights, 3)
            for k, own in enumerate(copies.T):
                values, at = np.unique(own, return_inverse=True)
                for value, n in zip(values.tolist(), np.bincount(at, weights).tolist()):
                    total[k, value] += int(n)
        features_, values = list(zip(*total)) or [()] * 2
        yield pa.RecordBatch.from_arrays(
            [pa.array(features_, pa.int32()), pa.array(values, pa.int32()), pa.array(total.values(), pa.int64())],
            names=["feature", "value", "n"],
        )

    found = known.mapInArrow(count, "feature int, value int, n long").groupBy("feature", "value").agg(F.sum("n").alias("n"))
    counted = np.array([tuple(x) for x in found.collect()], np.int64)  # a value is below a few hundred
    return [cuts_of(*counted[counted[:, 0] == k, 1:].T) for k in range(WIDTH)]


def _placed_blocks(known: DataFrame, cells_known: int, cuts: list[np.ndarray]) -> DataFrame:
    """The cells with their hidden copies as written blocks of (places, marks, weights); equal ones are one row.

    There are as many partitions as their number asks for, whatever a shuffle is dealt over, as each level of
    each tree is a job over them."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, marks, weights, masks in _blocks(batches):
            found = placed(hidden(rows, masks), cuts).astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([found[k : k + WIDTH] for k in range(0, len(found), WIDTH)], pa.binary()),
                    pa.array(np.tile(marks > 0, 3)),
                    pa.array(np.tile(weights, 3)),
                ],
                names=["places", "mark", "n"],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                block = (
                    b"".join(batch.column(0).to_pylist()),
                    batch.column(1).to_numpy(zero_copy_only=False).tobytes(),
                    batch.column(2).to_numpy().tobytes(),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own], pa.binary()) for own in block], names=["places", "marks", "weights"]
                )

    copies = known.mapInArrow(place, "places binary, mark boolean, n long")
    equal = copies.groupBy("places", "mark").agg(F.sum("n").alias("n"))
    equal = equal.coalesce(-(-3 * cells_known // TASK_CELLS))
    return frames.written(equal.mapInArrow(pack, "places binary, marks binary, weights binary"))


def _summed(blocks: DataFrame, tasks: int, grown: Boosted, tree: Tree, level: int) -> np.ndarray:
    """The sums over all blocks, by one job. Its tasks' sums are added by the driver, or, where more tasks
    than TOGETHER are needed, by a second round of fewer tasks first.

    The job runs in the workers that all other steps use: those of an RDD would be others beside them."""
    size = (2, 2**level, WIDTH, PLACES)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for places, marks, weights in zip(*(batch.column(k).to_pylist() for k in range(3))):
                total += block_sums(
                    np.frombuffer(places, np.uint8).reshape(-1, WIDTH),
                    np.frombuffer(marks, bool).astype(float),
                    np.frombuffer(weights, np.int64),
                    grown,
                    tree,
                    level,
                )
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for own in batch.column(0).to_pylist():
                total += np.frombuffer(own, np.int64).reshape(size)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    parts = blocks.mapInArrow(add, "sums binary")
    if tasks > TOGETHER:
        parts = parts.repartition(math.isqrt(tasks)).mapInArrow(merge, "sums binary")
    return sum(np.frombuffer(own["sums"], np.int64).reshape(size) for own in parts.collect())


def _cuts_kept(held: DataFrame, trees: Boosted) -> tuple[float, ...]:
    """The cut of each kind, from all proposals of the documents not learned from."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, marks, weights, _ in _blocks(batches):
            level = np.floor(trees.scores(rows) * LEVELS).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[:, 0]), pa.array(level), pa.array(marks > 0), pa.array(weights)],
                names=["kind", "level", "mark", "n"],
            )

    scored = held.mapInArrow(score, "kind long, level long, mark boolean, n long")
    found = scored.groupBy("kind", "level", "mark").agg(F.sum("n").alias("n")).collect()
    cuts = []
    for kind in range(len(KINDS)):
        own = np.array([(x["level"] / LEVELS, x["mark"], x["n"]) for x in found if x["kind"] == kind])
        cuts.append(cut_at(own[:, 0], own[:, 1] > 0, weights=own[:, 2]) if len(own) else 2.0)
    return tuple(cuts)


def fit(docs: DataFrame) -> Model:
    """Learns from all proposals of all documents. A table without proposals of both marks gives no trees."""
    every = frames.written(cells(docs))
    known = every.filter("learn")
    found = known.groupBy("mark").agg(F.sum("n").alias("n"), F.count("n").alias("cells")).collect()
    counts = {x["mark"]: x["n"] for x in found}
    if len(counts) == 2:
        cuts = _counted(known)
        blocks = _placed_blocks(known, sum(x["cells"] for x in found), cuts)
        sums = partial(_summed, blocks, len(blocks.inputFiles()))
        trees = boosted(sums, counts[True] / sum(counts.values()), cuts)
        frames.removed(blocks)
        model = Model(trees, _cuts_kept(every.filter("not learn"), trees))
    else:
        model = Model(None, (2.0,) * len(KINDS))
    frames.removed(every)
    return model


def cut_at(
    scores: np.ndarray, marks: np.ndarray, precision: float = PRECISION, weights: np.ndarray | None = None
) -> float:
    """The lowest score from which on the precision holds; 2 (never reached) if there is none."""
    order = np.argsort(-scores, kind="stable")
    weights = np.ones(len(order)) if weights is None else weights[order]
    right = np.cumsum(marks[order] * weights) / np.cumsum(weights)
    last = np.append(np.diff(scores[order]) != 0, True)  # equal scores stay together
    good = np.flatnonzero((right >= precision) & last)
    return float(max(scores[order][good[-1]], 0.5)) if len(good) else 2.0


def find(raw: bytes, model: Model) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans) of a text, as byte spans."""
    base = base_spans(raw)
    if model.trees is None:
        return base, []
    near = Nearby(base)
    inside = lambda span: any(
        start <= span[0] and span[1] <= end
        for kind in range(len(KINDS))
        for start, end, _ in near.overlapping(span, kind)
    )
    rivals = [span for span in proposals(raw) if not inside(span)]
    if not rivals:
        return base, []
    scores = model.trees.scores(np.array([features(raw, span) for span in rivals], float))
    reached = [
        (span[0], -span[1], -score, span)
        for score, span in zip(scores, rivals)
        if score >= model.cuts[span[2]]
    ]
    added, done = [], 0
    for *_, span in sorted(reached):
        if span[1] > done:  # else it lies in a span before it
            added.append(span)
            done = span[1]
    return base, added


def personal_data(docs: DataFrame, model: Model, rows: bool = False) -> DataFrame:
    """One row per document: doc_id, text, redacted (each span replaced by its kind in brackets),
    spans array<struct<start,end,kind,base>> in code points of the text, and if asked for the whole
    document as the struct `row`.

    Null texts are empty. Ids may be null or repeat; other columns are not read. Where the whole document
    is asked for, its text is sent once, inside it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, redacted string, spans array<struct<start:int,end:int,kind:string,base:boolean>>"
    kind_type = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames.kept_by("")  # models of earlier stages are done with
        for batch in frames.shorter(batches):
            text = batch.column(1)
            if rows:
                text = pc.fill_null(pc.struct_field(text, "text").cast(pa.string()), "")
            shown, spans = [], []
            for raw in frames.raw_column(text):
                base, added = find(raw, shared.value)
                shown.append(redacted(raw, base + added).decode())
                spans.append(
                    [
                        (start, end, KINDS[kind], own)
                        for own, group in ((True, base), (False, added))
                        for start, end, kind in sorted(in_code_points(raw, group))
                    ]
                )
            yield frames.carried(
                batch,
                [batch.column(0), pa.array(shown, pa.string()), pa.array(spans, kind_type)]
                + ([] if rows else [text]),
                ["doc_id", "redacted", "spans"] + ([] if rows else ["text"]),
            )

    sent = frames.with_rows(docs).select("doc_id", "row") if rows else frames.texts(docs)
    found = sent.mapInArrow(run, frames.carrying(schema if rows else schema + ", text string", sent))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("text") if rows else "text"
    return found.select("doc_id", text, "redacted", "spans", *(["row"] if rows else []))


def redacted(raw: bytes, spans: list[Span]) -> bytes:
    """Overlapping spans become one mark, of the first of them."""
    if not spans:
        return raw
    out, done = [], 0
    for start, end, kind in sorted(spans):
        if start >= done:
            out += [raw[done:start], f"[{KINDS[kind].upper()}]".encode()]
        done = max(done, end)
    return b"".join(out) + raw[done:]


def personal_digests(docs: DataFrame, model: Model) -> DataFrame:
    """Counts and digests of the base spans, and all spans as text, from the same search."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    counted = ", ".join(f"n_{kind} long" for kind in KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames.shorter(batches):
            counts, shown, everything = [], [], []
            for raw in frames.raw_column(batch.column(1)):
                base, added = find(raw, shared.value)
                spans = in_code_points(raw, base + added)
                own = spans[: len(base)]
                counts.append([sum(span[2] == kind for span in own) for kind in range(len(KINDS))])
                shown.append(digest(listed(own, KINDS)))
                everything.append(listed(spans, KINDS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array([count[kind] for count in counts], pa.int64()) for kind in range(len(KINDS))),
                    pa.array(shown, pa.string()),
                    pa.array(everything, pa.string()),
                ],
                names=["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"],
            )

    schema = f"doc_id long, {counted}, base_sha256 string, spans string"
    return frames.texts(docs).mapInArrow(run, schema)


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = frames.table(spark, folder, "documents")
    return personal_digests(docs, fit(docs))

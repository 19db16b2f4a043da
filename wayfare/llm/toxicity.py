"""Toxicity by class-conditional Kneser-Ney models over the bytes of words.

Both classes have their own counts of n-grams at the highest order and share all backoff: below it,
the continuation counts of the whole training corpus. So an expression that neither class has seen is
as likely under both, and a rare one differs only as far as its own counts do. A word's evidence is
the difference of its two log-likelihoods; divided by lengths, it is compared for the document and
for its most toxic words, and a logistic curve turns that into a score.

All n-grams are kept. A model measured to be small is sent to the tasks; a larger one stays a table,
whose totals come from grouped joins and which the distinct words are joined with. Both give the same.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.llm import frames
from wayfare.llm.decontaminate import words_of
from wayfare.operators.sides import bounded_side

#: Bytes of the longest n-gram; up to seven fit into one number with their length.
ORDER = 7
DISCOUNT = 0.9
#: Folds that are learned from.
FOLDS = (0, 1, 3)
#: N-grams of a model that is sent to the tasks; if there are more, all of them stay in tables.
MODEL_ENTRIES = 1_000_000
#: Labelled documents that the logistic curve is fitted on, about.
CURVE_DOCUMENTS = 20_000
#: Words whose evidence a worker keeps.
KEPT_WORDS = 400_000
#: A longer word is scored in pieces of so many bytes.
LONGEST_WORD = 64
#: The most toxic words of a document that count by themselves.
TOP = 3
DOC_FEATURES = 2 + TOP


def fold_of(doc_id: int | None) -> int:
    """crc32 of the id as text, modulo 4; null ids count as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4


def fold(column: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 4


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, number of the word of each) of words with a space before and after.

    Every byte but the first space is predicted from up to ORDER - 1 bytes before it in the word.
    """
    sizes = np.array([len(word) + 2 for word in words], np.int64)
    data = np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    inside = np.arange(len(data)) - starts[owner]
    at = np.flatnonzero(inside > 0)
    keys = np.zeros(len(at), np.uint64)
    for k in range(ORDER):
        valid = inside[at] >= k
        keys[valid] |= data[at[valid] - k] << np.uint64(8 * k)
    length = np.minimum(inside[at] + 1, ORDER).astype(np.uint64)
    return keys | length << np.uint64(56), owner[at]


def context_of(keys: np.ndarray) -> np.ndarray:
    """The n-gram without its last byte."""
    low = keys & np.uint64((1 << 56) - 1)
    return low >> np.uint64(8) | ((keys >> np.uint64(56)) - np.uint64(1)) << np.uint64(56)


def suffix_of(keys: np.ndarray) -> np.ndarray:
    """The n-gram without its first byte."""
    length = (keys >> np.uint64(56)) - np.uint64(1)
    low = keys & ((np.uint64(1) << (length * np.uint64(8))) - np.uint64(1))
    return low | length << np.uint64(56)


class Evidence(NamedTuple):
    """Log-likelihood differences: of known n-grams, and of contexts followed by anything else."""

    keys: np.ndarray
    values: np.ndarray
    contexts: np.ndarray
    context_values: np.ndarray

    def of(self, words: list[bytes]) -> np.ndarray:
        """The summed difference of every word."""
        found, owner = grams(words)
        values = np.zeros(len(found))
        contexts = context_of(found)
        at = np.searchsorted(self.contexts, contexts)
        known = at < len(self.contexts)
        known[known] = self.contexts[at[known]] == contexts[known]
        values[known] = self.context_values[at[known]]
        at = np.searchsorted(self.keys, found)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == found[known]
        values[known] = self.values[at[known]]
        return np.bincount(owner, values, minlength=len(words))


def _shared(keys: np.ndarray) -> np.ndarray:
    """Interpolated Kneser-Ney probability of every n-gram's last byte after its context without the
    first byte, from continuation counts alone; keys are distinct."""
    if not len(keys):
        return np.zeros(0)
    suffixes = suffix_of(keys)
    length = suffixes >> np.uint64(56)
    distinct, back, counts = np.unique(suffixes, return_inverse=True, return_counts=True)
    contexts, of_context = np.unique(context_of(distinct), return_inverse=True)
    total = np.bincount(of_context, counts, minlength=len(contexts))
    kinds = np.bincount(of_context, minlength=len(contexts))
    own = np.maximum(counts - DISCOUNT, 0) / total[of_context]
    left = DISCOUNT * kinds[of_context] / total[of_context]
    lower = np.full(len(distinct), 1 / 256)
    more = (distinct >> np.uint64(56)) > np.uint64(1)
    if more.any():
        lower[more] = _shared(distinct[more])
    found = (own + left * lower)[back]
    return np.where(length > np.uint64(0), found, 1 / 256)


def evidence(keys: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> Evidence:
    """From distinct n-grams with their counts in both classes."""
    order = np.argsort(keys)
    keys, sides = keys[order], (toxic[order].astype(float), ordinary[order].astype(float))
    contexts, of_context = np.unique(context_of(keys), return_inverse=True)
    shared = _shared(keys)
    logs, left_logs = [], []
    for counts in sides:
        total = np.bincount(of_context, counts, minlength=len(contexts))
        kinds = np.bincount(of_context, counts > 0, minlength=len(contexts))
        left = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
        own = np.maximum(counts - DISCOUNT, 0) / np.maximum(total, 1)[of_context]
        logs.append(np.log(own + left[of_context] * shared))
        left_logs.append(np.log(left))
    return Evidence(keys, logs[0] - logs[1], contexts, left_logs[0] - left_logs[1])


def count_grams(labelled: DataFrame) -> DataFrame:
    """gram, and its counts over all words of (text, side) rows for every side below 2 * FOLDS."""
    sides = 2 * len(FOLDS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [Counter() for _ in range(sides)]

        def summed() -> pa.RecordBatch:
            keys, sums = [], []
            for side, own in enumerate(words):
                if own:
                    found, owner = grams(list(own))
                    distinct, back = np.unique(found, return_inverse=True)
                    times = np.fromiter(own.values(), np.int64)[owner]
                    table = np.zeros((sides, len(distinct)), np.int64)
                    table[side] = np.bincount(back, times, minlength=len(distinct)).astype(np.int64)
                    keys.append(distinct)
                    sums.append(table)
                    own.clear()
            flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            table = np.concatenate(sums, axis=1) if sums else np.zeros((sides, 0), np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(flat.view(np.int64)), *(pa.array(row) for row in table)],
                names=["gram", *(f"n{side}" for side in range(sides))],
            )

        for batch in frames.shorter(batches):
            for raw, side in zip(frames.raw_column(batch.column(0)), batch.column(1).to_pylist()):
                words[side].update(cut(words_of(raw)))
            if sum(map(len, words)) > 200_000:
                yield summed()
        yield summed()

    schema = "gram long" + "".join(f", n{side} long" for side in range(sides))
    found = labelled.mapInArrow(count, schema)
    return found.groupBy("gram").agg(*(F.sum(f"n{side}").alias(f"n{side}") for side in range(sides)))


def cut(words: list[bytes]) -> list[bytes]:
    """Long words in pieces, so that every byte counts."""
    if max(map(len, words), default=0) <= LONGEST_WORD:
        return words
    return [
        word[at : at + LONGEST_WORD] for word in words for at in range(0, len(word), LONGEST_WORD)
    ]


def used_folds(fold_place: int | None) -> list[int]:
    return [k for k in range(len(FOLDS)) if k != fold_place]


def collected(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(distinct n-grams, their counts by side) of a counted table that was measured to be small."""
    found = counted.toArrow()
    keys = found.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    return keys, np.stack([found.column(f"n{side}").to_numpy() for side in range(2 * len(FOLDS))])


def evidence_without(keys: np.ndarray, counts: np.ndarray, fold_place: int | None) -> Evidence:
    """The evidence of all folds but one."""
    used = used_folds(fold_place)
    toxic = sum(counts[2 * k + 1] for k in used)
    ordinary = sum(counts[2 * k] for k in used)
    seen = toxic + ordinary > 0
    return evidence(keys[seen], toxic[seen], ordinary[seen])


#: Models in one table: without each fold, and of all folds.
PLACES = (*range(len(FOLDS)), None)
# The operations on n-grams as SQL.
GRAM_LENGTH = "shiftright(gram, 56)"
GRAM_CONTEXT = "(shiftright(gram & 72057594037927935L, 8) | shiftleft(shiftright(gram, 56) - 1L, 56))"
GRAM_SUFFIX = (
    "((gram & (shiftleft(1L, cast(8 * (shiftright(gram, 56) - 1) as int)) - 1L))"
    " | shiftleft(shiftright(gram, 56) - 1L, 56))"
)


class Tables(NamedTuple):
    """The same as Evidence, as tables (gram, v0, ...) and (context, c0, ...) with a column per model."""

    grams: DataFrame
    contexts: DataFrame
    place: int | None

    def of(self, words: DataFrame) -> DataFrame:
        """word, value: the summed difference of every distinct word."""
        model = PLACES.index(self.place)

        def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in frames.shorter(batches, 4096):
                own = frames.raw_column(batch.column(0))
                if own:
                    keys, owner = grams(own)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(owner)),
                            pa.array(np.arange(len(keys)) - np.searchsorted(owner, owner)),
                            pa.array(keys.view(np.int64)),
                            pa.array(context_of(keys).view(np.int64)),
                        ],
                        names=["word", "at", "gram", "context"],
                    )

        found = words.mapInArrow(pieces, "word binary, at long, gram long, context long")
        found = found.join(
            bounded_side(self.grams.select("gram", F.col(f"v{model}").alias("v"))), "gram", "left"
        ).join(
            bounded_side(self.contexts.select("context", F.col(f"c{model}").alias("c"))), "context", "left"
        )
        # Summed in the order of the word, as floating-point sums depend on it; a word has few n-grams.
        values = F.array_sort(F.collect_list(F.struct("at", F.coalesce("v", "c", F.lit(0.0)).alias("value"))))
        return found.groupBy("word").agg(
            F.aggregate(values, F.lit(0.0), lambda total, x: total + x["value"]).alias("value")
        )


def table_evidence(counted: DataFrame) -> Tables:
    """The evidence of all models from a table of counted n-grams, by grouped joins alone.

    Every group and every join key has no more than 256 rows: n-grams that differ in one byte.
    """
    count = range(len(PLACES))
    side = {
        f"{name}{m}": sum((F.col(f"n{2 * k + own}") for k in used_folds(place)), F.lit(0).cast("long"))
        for m, place in enumerate(PLACES)
        for own, name in enumerate("ot")
    }
    base = counted.select("gram", *(value.alias(name) for name, value in side.items()))
    level = base.select(
        "gram", *((F.col(f"t{m}") + F.col(f"o{m}") > 0).cast("long").alias(f"n{m}") for m in count)
    )
    levels = []
    for _ in range(ORDER - 1):
        level = frames.written(
            level.filter(f"{GRAM_LENGTH} > 1")
            .groupBy(F.expr(GRAM_SUFFIX).alias("gram"))
            .agg(*(F.sum((F.col(f"n{m}") > 0).cast("long")).alias(f"n{m}") for m in count))
        )
        levels.append(level)

    same = Window.partitionBy(F.expr(GRAM_CONTEXT))
    total = lambda name: F.sum(name).over(same)
    kinds = lambda name: F.sum((F.col(name) > 0).cast("long")).over(same)
    shared = None
    for level in reversed(levels):
        parts = level.select(
            "gram",
            F.expr(f"if({GRAM_LENGTH} > 1, {GRAM_SUFFIX}, null)").alias("suffix"),
            *(F.col(f"n{m}") for m in count),
            *(F.greatest(total(f"n{m}"), F.lit(1)).alias(f"total{m}") for m in count),
            *(kinds(f"n{m}").alias(f"kinds{m}") for m in count),
        )
        if shared is None:
            parts = parts.select("*", *(F.lit(1 / 256).alias(f"p{m}") for m in count))
        else:
            parts = parts.join(shared, "suffix", "left")
        shared = bounded_side(
            parts.select(
                F.col("gram").alias("suffix"),
                *(
                    (
                        F.greatest(F.col(f"n{m}") - F.lit(DISCOUNT), F.lit(0.0)) / F.col(f"total{m}")
                        + F.lit(DISCOUNT) * F.col(f"kinds{m}") / F.col(f"total{m}")
                        * F.coalesce(f"p{m}", F.lit(1 / 256))
                    ).alias(f"p{m}")
                    for m in count
                ),
            )
        )
    names = [f"{name}{m}" for m in count for name in "to"]
    parts = base.select(
        "gram",
        F.expr(GRAM_CONTEXT).alias("context"),
        F.expr(GRAM_SUFFIX).alias("suffix"),
        *names,
        *(total(name).alias(f"total_{name}") for name in names),
        *(kinds(name).alias(f"kinds_{name}") for name in names),
    ).join(shared, "suffix")

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            values, of_contexts = [], []
            for m in count:
                logs, left_logs = [], []
                for name in (f"t{m}", f"o{m}"):
                    counts, whole = column(name), column(f"total_{name}")
                    left = np.where(whole > 0, DISCOUNT * column(f"kinds_{name}") / np.maximum(whole, 1), 1.0)
                    own = np.maximum(counts - DISCOUNT, 0) / np.maximum(whole, 1)
                    logs.append(np.log(own + left * column(f"p{m}")))
                    left_logs.append(np.log(left))
                of_contexts.append(left_logs[0] - left_logs[1])
                seen = column(f"t{m}") + column(f"o{m}") > 0
                values.append(np.where(seen, logs[0] - logs[1], of_contexts[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("gram"), batch.column("context"), *map(pa.array, values + of_contexts)],
                names=["gram", "context", *(f"v{m}" for m in count), *(f"c{m}" for m in count)],
            )

    fields = [f"{name}{m} double" for name in "vc" for m in count]
    found = frames.written(parts.mapInArrow(differences, ", ".join(["gram long", "context long", *fields])))
    for level in levels:
        frames.removed(level)
    # All rows of a context have the same values.
    contexts = found.groupBy("context").agg(*(F.max(f"c{m}").alias(f"c{m}") for m in count))
    return Tables(found.select("gram", *(f"v{m}" for m in count)), frames.written(contexts), None)


def described(words: list[bytes], rates: list[float]) -> np.ndarray:
    """Of a text's words with their differences per byte: whether there are any, the difference per
    byte of all, and those of the TOP words."""
    row = np.zeros(DOC_FEATURES)
    if words:
        rates = np.array(rates)
        sizes = np.array([len(word) + 1 for word in words])
        row[0], row[1] = 1, rates @ sizes / sizes.sum()
        top = np.sort(rates[np.argpartition(-rates, TOP - 1)[:TOP]] if len(rates) > TOP else rates)
        row[2 : 2 + len(top)] = top[::-1]
    return row


class Scorer:
    """Features of texts, with the evidence of known words kept."""

    def __init__(self, model: Evidence):
        self.model, self.known = model, {}

    def features(self, texts: list[bytes]) -> np.ndarray:
        """A row of described() per text."""
        split = [cut(words_of(raw)) for raw in texts]
        new = list({word for words in split for word in words if word not in self.known})
        if new:
            values = self.model.of(new) / np.array([len(word) + 1 for word in new])
            if len(self.known) + len(new) > KEPT_WORDS:
                self.known.clear()
                new = list({word for words in split for word in words})
                values = self.model.of(new) / np.array([len(word) + 1 for word in new])
            self.known.update(zip(new, values.tolist()))
        rows = [described(words, [self.known[word] for word in words]) for words in split]
        return np.array(rows).reshape(len(texts), DOC_FEATURES)


def with_known(docs: DataFrame, tables: Tables) -> DataFrame:
    """The documents with `known`, the evidence of their distinct words, joined from the tables."""
    docs = frames.written(docs.withColumn("__row", F.monotonically_increasing_id()))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames.shorter(batches):
            own, words = [], []
            for number, raw in zip(batch.column(0).to_pylist(), frames.raw_column(batch.column(1))):
                distinct = set(cut(words_of(raw)))
                own += [number] * len(distinct)
                words += distinct
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64()), pa.array(words, pa.binary())], names=["__row", "word"]
            )

    words = docs.select("__row", "text").mapInArrow(split, "__row long, word binary")
    values = bounded_side(tables.of(words.select("word").distinct()))
    known = words.join(values, "word").groupBy("__row").agg(
        F.collect_list(F.struct("word", "value")).alias("known")
    )
    return docs.join(known, "__row", "left").drop("__row")


def known_features(batch: pa.RecordBatch, text: str = "text") -> np.ndarray:
    """A row of described() per text of a batch of with_known()."""
    rows = []
    for raw, pairs in zip(frames.raw_column(batch.column(text)), batch.column("known").to_pylist()):
        rates = {pair["word"]: pair["value"] / (len(pair["word"]) + 1) for pair in pairs or ()}
        words = cut(words_of(raw))
        rows.append(described(words, [rates[word] for word in words]))
    return np.array(rows).reshape(batch.num_rows, DOC_FEATURES)


class Curve(NamedTuple):
    """A logistic curve over scaled features."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = ((rows - self.centre) / self.scale) @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_curve(rows: np.ndarray, marks: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> Curve:
    """By Newton's method with a ridge; without rows or with one class, the share of marks."""
    width = rows.shape[1]
    centre = rows.mean(axis=0) if len(rows) else np.zeros(width)
    scale = rows.std(axis=0) if len(rows) else np.ones(width)
    scale = np.where(scale > 0, scale, 1.0)
    weights = np.zeros(width + 1)
    if not len(rows) or marks.all() or not marks.any():
        share = (marks.sum() + 0.1) / (len(marks) + 1)
        weights[0] = np.log(share / (1 - share))
        return Curve(centre, scale, weights)
    full = np.hstack([np.ones((len(rows), 1)), (rows - centre) / scale])
    penalty = np.diag([0.0] + [ridge] * width)
    for _ in range(rounds):
        chances = 1 / (1 + np.exp(-np.clip(full @ weights, -30, 30)))
        slope = full.T @ (chances - marks) + penalty @ weights
        bend = (full * (chances * (1 - chances))[:, None]).T @ full + penalty + 1e-9 * np.eye(width + 1)
        step = np.linalg.solve(bend, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return Curve(centre, scale, weights)


class Model(NamedTuple):
    evidence: Evidence | Tables
    curve: Curve


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic of documents with a label; of several labels of an id, the highest."""
    marks = labels.filter("toxic is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    # Sent to all tasks if it was measured to be small; else both sides are shuffled.
    return frames.texts(docs).join(bounded_side(marks), "doc_id")


def fit(labelled: DataFrame, curve_documents: int = CURVE_DOCUMENTS, entries: int = MODEL_ENTRIES) -> Model:
    """Learns from (doc_id, text, toxic) rows outside fold 2, all of which are counted.

    A model of more than `entries` n-grams stays in tables; the results are the same.
    The curve is fitted on about curve_documents of them, chosen by a hash of the id; each is
    described by the models of the other folds, which have not seen it.
    """
    place = sum((F.when(F.col("__fold") == own, k).otherwise(0) for k, own in enumerate(FOLDS)), F.lit(0))
    labelled = labelled.withColumn("__fold", fold()).filter(F.col("__fold").isin(*FOLDS))
    labelled = frames.written(
        labelled.select(
            "doc_id", "text", place.alias("place"), (F.col("toxic") == 1).cast("int").alias("toxic")
        )
    )
    side = (F.col("place") * 2 + F.col("toxic")).cast("int")
    counted = frames.written(count_grams(labelled.select("text", side.alias("side"))))
    if counted.count() <= entries:
        keys, counts = collected(counted)
        frames.removed(counted)
        without = lambda place: evidence_without(keys, counts, place)
    else:
        tables = table_evidence(counted)
        frames.removed(counted)
        without = lambda place: tables._replace(place=place)
    count, grain = labelled.count(), 1 << 20
    share = min(grain, int(grain * curve_documents / max(count, 1)) + 1)
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < share)
    rows, marks = [], []
    for k in range(len(FOLDS)):
        own = chosen.filter(F.col("place") == k).select("text", "toxic")
        for row, mark in _described(own, without(k)):
            rows.append(row)
            marks.append(mark)
    frames.removed(labelled)
    curve = fit_curve(np.array(rows).reshape(len(rows), DOC_FEATURES), np.array(marks, float))
    return Model(without(None), curve)


def _described(rows: DataFrame, model: Evidence | Tables) -> list[tuple[tuple[float, ...], int]]:
    """The features of (text, mark) rows, in a fixed order."""
    stored = isinstance(model, Tables)
    shared = rows.sparkSession.sparkContext.broadcast(None if stored else model)
    if stored:
        rows = with_known(rows, model)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None if stored else Scorer(shared.value)
        for batch in frames.shorter(batches):
            found = known_features(batch) if stored else scorer.features(frames.raw_column(batch.column(0)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.list_(pa.float64())), batch.column(1)], names=["row", "mark"]
            )

    found = rows.mapInArrow(describe, "row array<double>, mark int")
    return sorted((tuple(x["row"]), x["mark"]) for x in found.collect())


def toxicity(docs: DataFrame, model: Model, limit: float = 0.3, rows: bool = False) -> DataFrame:
    """One row per document: doc_id, score (0 to 1), predicted (1 if score >= limit, else 0), and if
    asked for the whole document as the struct `row`.

    Null texts are empty; texts without words have the score of no evidence. Ids may be null or
    repeat; other columns are not read.
    """
    stored = isinstance(model.evidence, Tables)
    shared = docs.sparkSession.sparkContext.broadcast(model._replace(evidence=None) if stored else model)
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = frames.kept_by(name)
        if not scorers and not stored:
            scorers[name] = Scorer(shared.value.evidence)
        scorer = scorers.get(name)
        for batch in frames.shorter(batches):
            found = known_features(batch) if stored else scorer.features(frames.raw_column(batch.column(1)))
            scores = shared.value.curve.scores(found)
            predicted = pa.array((scores >= limit).astype(np.int32))
            yield frames.carried(
                batch,
                [batch.column(0), pa.array(scores), predicted],
                ["doc_id", "score", "predicted"],
            )

    docs = frames.with_rows(docs) if rows else frames.texts(docs)
    fields = frames.carrying("doc_id long, score double, predicted int", docs)
    if stored:
        docs = with_known(docs, model.evidence)
    return docs.mapInArrow(run, fields)


def op9_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    docs = frames.table(spark, folder, "documents")
    model = fit(labelled_texts(docs, frames.table(spark, folder, "labels")))
    return toxicity(docs, model).select(
        "doc_id", (fold() == 2).alias("held_out"), "score", "predicted"
    )

"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word in both directions and gives every position a probability for
each language; a document's probabilities are the means over all positions of its whole text. It is
trained here, in numpy, by backpropagation through time. A word's positions depend on the word alone,
so a worker keeps the sums of words it has seen.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import frames
from wayfare.llm.decontaminate import words_of
from wayfare.llm.toxicity import fold

#: Units of each direction.
UNITS = 16
#: A longer word is read in pieces of so many bytes.
PIECE = 32
#: Documents (about) and distinct words of each language that the network learns from, at most.
SAMPLE_DOCUMENTS = 400
SAMPLE_WORDS = 15_000
#: Languages that can be told apart; with more, the fit is refused.
MOST_LANGUAGES = 500
EPOCHS, BATCH, RATE = 4, 256, 0.01
#: Words whose sums a worker keeps.
KEPT_WORDS = 300_000
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * values) + 0.5


def initial(languages: int, seed: int = 5) -> dict[str, np.ndarray]:
    """Per direction d: a row of gate inputs for each byte (E), recurrent weights (U) and the bias of
    the candidate's recurrent part (B); V and C read both states."""
    chance = np.random.default_rng(seed)
    found = {}
    for d in "fb":
        found["E" + d] = chance.normal(0, 0.3, (256, 3 * UNITS))
        found["U" + d] = chance.normal(0, 1 / np.sqrt(UNITS), (UNITS, 3 * UNITS))
        found["B" + d] = np.zeros(UNITS)
    found["V"] = chance.normal(0, 1 / np.sqrt(2 * UNITS), (2 * UNITS, languages))
    found["C"] = np.zeros(languages)
    return {name: value.astype(np.float32) for name, value in found.items()}


def _run(weights, d: str, letters: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (time, word, unit) of one direction over words of one length (word, time)."""
    count, length = letters.shape
    table, recurrent, bias = weights["E" + d], weights["U" + d], weights["B" + d]
    states = np.empty((length, count, UNITS), table.dtype)
    state = np.zeros((count, UNITS), table.dtype)
    for t in range(length) if d == "f" else range(length - 1, -1, -1):
        given = table[letters[:, t]]
        pulled = state @ recurrent
        gates = _sigmoid(given[:, : 2 * UNITS] + pulled[:, : 2 * UNITS])
        update, reset = gates[:, :UNITS], gates[:, UNITS:]
        inner = pulled[:, 2 * UNITS :] + bias
        candidate = np.tanh(given[:, 2 * UNITS :] + reset * inner)
        if keep is not None:
            keep.append((t, state, update, reset, inner, candidate))
        state = candidate + update * (state - candidate)
        states[t] = state
    return states


def probabilities(weights, letters: np.ndarray, keep: tuple[list, list] | None = None):
    """(states of both directions, probabilities), each with axes (time, word, ...)."""
    states = np.concatenate(
        [_run(weights, d, letters, keep[k] if keep else None) for k, d in enumerate("fb")], axis=2
    )
    raised = states @ weights["V"] + weights["C"]
    raised = np.exp(raised - raised.max(axis=2, keepdims=True))
    return states, raised / raised.sum(axis=2, keepdims=True)


def loss_and_slopes(weights, letters: np.ndarray, marks: np.ndarray, share: np.ndarray):
    """Mean cross entropy over positions, each weighted with its word's share, and its slopes."""
    kept: tuple[list, list] = ([], [])
    states, chances = probabilities(weights, letters, kept)
    length, count, _ = chances.shape
    weight = share / (share.sum() * length)
    picked = chances[:, np.arange(count), marks]
    loss = float(-(np.log(np.maximum(picked, 1e-30)) * weight).sum())
    slope = chances.copy()
    slope[:, np.arange(count), marks] -= 1
    slope *= weight[None, :, None]
    slopes = {name: np.zeros_like(value) for name, value in weights.items()}
    slopes["V"] = np.tensordot(states, slope, ([0, 1], [0, 1]))
    slopes["C"] = slope.sum(axis=(0, 1))
    into = slope @ weights["V"].T
    for k, d in enumerate("fb"):
        own = into[:, :, k * UNITS : (k + 1) * UNITS]
        later = np.zeros((count, UNITS), own.dtype)
        for t, state, update, reset, inner, candidate in reversed(kept[k]):
            total = own[t] + later
            to_candidate = total * (1 - update) * (1 - candidate**2)
            to_update = total * (state - candidate) * update * (1 - update)
            to_reset = to_candidate * inner * reset * (1 - reset)
            to_inner = to_candidate * reset
            given = np.concatenate([to_update, to_reset, to_candidate], axis=1)
            pulled = np.concatenate([to_update, to_reset, to_inner], axis=1)
            np.add.at(slopes["E" + d], letters[:, t], given)
            slopes["U" + d] += state.T @ pulled
            slopes["B" + d] += to_inner.sum(axis=0)
            later = total * update + pulled @ weights["U" + d].T
    return loss, slopes


def train(words: list[bytes], marks: np.ndarray, share: np.ndarray, languages: int, seed: int = 5):
    """Adam over batches of words of one length, in a fixed order of its own."""
    weights = initial(languages, seed)
    chance = np.random.default_rng(seed)
    groups: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        groups.setdefault(len(word), []).append(k)
    letters = {
        size: np.frombuffer(b"".join(words[k] for k in own), np.uint8).reshape(-1, size)
        for size, own in groups.items()
    }
    first = {name: np.zeros_like(value) for name, value in weights.items()}
    second = {name: np.zeros_like(value) for name, value in weights.items()}
    step = 0
    for epoch in range(EPOCHS):
        batches = []
        for size, own in groups.items():
            order = chance.permutation(len(own))
            batches += [(size, order[at : at + BATCH]) for at in range(0, len(order), BATCH)]
        for place in chance.permutation(len(batches)):
            size, chosen = batches[place]
            own = np.array(groups[size])[chosen]
            _, slopes = loss_and_slopes(weights, letters[size][chosen], marks[own], share[own])
            step += 1
            rate = RATE * (0.3**epoch)
            for name, slope in slopes.items():
                first[name] += 0.1 * (slope - first[name])
                second[name] += 0.01 * (slope**2 - second[name])
                ahead = first[name] / (1 - 0.9**step)
                weights[name] -= rate * ahead / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)
    return weights


class Model(NamedTuple):
    languages: tuple[str, ...]
    weights: dict[str, np.ndarray]


def pieces(words: list[bytes]) -> list[bytes]:
    """The words, those of more than PIECE bytes in pieces of whole characters."""
    if max(map(len, words), default=0) <= PIECE:
        return words
    out = []
    for word in words:
        at = 0
        while len(word) - at > PIECE:
            end = at + PIECE
            while word[end] & 0xC0 == 0x80 and end > at + PIECE - 4:
                end -= 1
            out.append(word[at:end])
            at = end
        out.append(word[at:])
    return out


def fit(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, kept: int = SAMPLE_WORDS) -> Model:
    """Learns from documents with a lang outside fold 2: of every language, about `documents` of them
    and at most `kept` of their distinct words, both chosen by hashes."""
    frames.importable(docs.sparkSession)
    learned = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("lang").cast("string").alias("lang"),
    ).filter(F.col("lang").isNotNull() & (fold() != 2))
    counts = learned.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = tuple(sorted(row["lang"] for row in counts))
    if not languages:
        return Model((), {})
    grain = 1 << 30
    shares = {row["lang"]: min(grain, int(grain * documents / row["count"]) + 1) for row in counts}
    limits = F.create_map(*(F.lit(x) for lang in languages for x in (lang, shares[lang])))
    chosen = learned.filter(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < limits[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in frames.shorter(batches):
            for raw, lang in zip(frames.raw_column(batch.column(0)), batch.column(1).to_pylist()):
                found.update((lang, word) for word in pieces(words_of(raw)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang for lang, _ in found], pa.string()),
                pa.array([word for _, word in found], pa.binary()),
                pa.array(list(found.values()), pa.int64()),
            ],
            names=["lang", "word", "n"],
        )

    from pyspark.sql import Window

    words = chosen.select("text", "lang").mapInArrow(count, "lang string, word binary, n long")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("word"), "word"))
    rows = words.withColumn("__nth", nth).filter(F.col("__nth") <= kept).collect()
    rows = sorted((row["lang"], bytes(row["word"]), row["n"]) for row in rows)
    place = {lang: k for k, lang in enumerate(languages)}
    marks = np.array([place[lang] for lang, _, _ in rows], np.int64)
    share = np.log1p(np.array([n for _, _, n in rows], np.float32))
    # Languages count alike, however many words of each there are.
    for k in range(len(languages)):
        share[marks == k] /= max(share[marks == k].sum(), 1e-9)
    share = share / share.mean() if len(share) else share
    return Model(languages, train([word for _, word, _ in rows], marks, share, len(languages)))


class Reader:
    """Document probabilities, with the sums of known words kept."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[bytes, int] = {}
        self.sums = np.zeros((KEPT_WORDS + 1, len(model.languages)), np.float32)

    def _sums(self, words: list[bytes]) -> np.ndarray:
        found = np.zeros((len(words), len(self.model.languages)), np.float32)
        groups: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            groups.setdefault(len(word), []).append(k)
        for size, own in groups.items():
            for at in range(0, len(own), 4096):
                part = own[at : at + 4096]
                letters = np.frombuffer(b"".join(words[k] for k in part), np.uint8)
                _, chances = probabilities(self.model.weights, letters.reshape(-1, size))
                found[part] = chances.sum(axis=0)
        return found

    def means(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over the positions of every text; zeros if it has none."""
        split = [pieces(words_of(raw)) for raw in texts]
        new = list({word for words in split for word in words if word not in self.known})
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known.clear()
            new = list({word for words in split for word in words})
        if len(new) > KEPT_WORDS:
            return np.concatenate([self.means([raw]) for raw in texts]) if len(texts) > 1 else self._alone(split[0])
        first = len(self.known)
        self.sums[first : first + len(new)] = self._sums(new)
        self.known.update(zip(new, range(first, first + len(new))))
        out = np.zeros((len(texts), len(self.model.languages)))
        for row, words in zip(out, split):
            if words:
                own = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
                row += self.sums[own].sum(axis=0, dtype=np.float64) / sum(map(len, words))
        return out

    def _alone(self, words: list[bytes]) -> np.ndarray:
        total = np.zeros((1, len(self.model.languages)))
        for at in range(0, len(words), 4096):
            total += self._sums(words[at : at + 4096]).sum(axis=0, dtype=np.float64)
        return total / sum(map(len, words))


def languages(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, lang_pred, score (its mean probability).

    A null text, one without letters, and any text if no language was learned, is `und` with score 0.
    Equal scores go to the language that sorts first. Only the text is read to predict.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = frames.kept_by(name)
        if not readers:
            readers[name] = Reader(shared.value)
        reader, known = readers[name], shared.value.languages
        for batch in frames.shorter(batches):
            texts = batch.column(1).to_pylist()
            named, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            asked = [k for k, text in enumerate(texts) if known and LETTER.search(text)]
            if asked:
                means = reader.means([texts[k].encode() for k in asked])
                for k, row in zip(asked, means):
                    best = int(row.argmax())
                    named[k], scores[k] = known[best], min(1.0, float(row[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(named, pa.string()), pa.array(scores)],
                names=["doc_id", "lang_pred", "score"],
            )

    return frames.texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op8_byte_network(spark: SparkSession, folder: str) -> DataFrame:
    docs = frames.table(spark, folder, "documents")
    found = languages(docs, fit(docs))
    return found.select("doc_id", (fold() == 2).alias("held_out"), "lang_pred", "score")

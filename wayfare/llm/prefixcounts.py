"""Exact token counts at every prefix of a text, by dynamic programming over BPE merges.

BPE gives a string exactly one token sequence, and a sequence is that one if and only if no merge
would cross a border between two neighbouring tokens. So the last token of a prefix is the one
suffix token whose border with the last token of the shorter prefix holds, and

    count[i] = count[i - length of that token] + 1

One pass over a word thus stores the count at each of its prefixes (each read as a word that ends
there), and prefixes of a text add up those of its words. Whether a text is over a limit, or where
to cut it, is looked up; nothing is encoded again.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from wayfare.llm import frames
from wayfare.llm.vocabulary import CONTRACTIONS, byte_letters, encoder

#: Words whose counts a worker keeps; later ones are worked out each time they occur.
KEPT_WORDS = 800_000
#: Border checks that a worker remembers.
KEPT_BORDERS = 500_000
ALWAYS = 1 << 60

WORDS = regex.compile(rf"{CONTRACTIONS}|\p{{L}}+|\p{{N}}|[^\s\p{{L}}\p{{N}}]+")


class Merges:
    """The merge rules of a BPE file, and the tokens of words' prefixes by them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocabulary: dict[str, int] = model["vocab"]
        self.size = max(self.vocabulary.values()) + 1
        self.rank: dict[int, int] = {}  # of left * size + right
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, rule in enumerate(model["merges"]):
            left, right = rule if isinstance(rule, list) else rule.split(" ")
            a, b = self.vocabulary[left], self.vocabulary[right]
            self.rank[a * self.size + b] = rank
            self.parts.setdefault(self.vocabulary[left + right], (a, b, rank))
        self.longest = max(map(len, self.vocabulary))
        self.borders: dict[int, bool] = {}

    @functools.cache
    def _edge(self, token: int, side: int) -> tuple[tuple[int, int, int], ...]:
        """(token, rank that made it, rank that absorbs it) of the tokens that a token's left
        (side 0) or right (side 1) edge is while the token is being merged."""
        found, absorbed = [], ALWAYS
        while True:
            rule = self.parts.get(token)
            found.append((token, rule[2] if rule else -1, absorbed))
            if rule is None:
                return tuple(found)
            token, absorbed = rule[side], rule[2]

    def holds(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border between two neighbouring tokens.

        A crossing merge happens if both its parts are at the border when its turn comes. Of two
        places of one rule the left goes first, so the border wins against its right neighbour.
        """
        key = left * self.size + right
        known = self.borders.get(key)
        if known is None:
            known = not self._crossed(left, right)
            if len(self.borders) < KEPT_BORDERS:
                self.borders[key] = known
        return known

    def _crossed(self, left: int, right: int) -> bool:
        rank_of, size, after = self.rank.get, self.size, self._edge(right, 0)
        for a, made_a, gone_a in self._edge(left, 1):
            a *= size
            for b, made_b, gone_b in after:
                rank = rank_of(a + b)
                if rank is not None and made_a < rank < gone_a and made_b < rank <= gone_b:
                    return True
        return False

    def _last(self, symbols: str, end: int, suffix: str, last: list[int]) -> tuple[int, int]:
        """The last token of symbols[:end] (its last one carrying suffix) and its start."""
        for start in range(max(0, end - self.longest), end):
            token = self.vocabulary.get(symbols[start:end] + suffix)
            if token is not None and (start == 0 or self.holds(last[start], token)):
                return token, start
        raise ValueError(f"no token ends at {end} of {symbols!r}")

    def prefixes(self, symbols: str, ends: list[int]) -> list[int]:
        """Token counts of symbols[:end] as a word, for each of the ends.

        symbols are the stand-ins of a word's bytes; ends is ascending.
        """
        last, count = [-1], [0]
        for end in range(1, len(symbols) + 1):
            token, start = self._last(symbols, end, "", last)
            last.append(token)
            count.append(count[start] + 1)
        if not self.suffix:
            return [count[end] for end in ends]
        return [count[self._last(symbols, end, self.suffix, last)[1]] + 1 for end in ends]


class PrefixCounter:
    """Counts for a tokenizer file whose words are split as in `vocabulary`."""

    def __init__(self, path: str):
        self.encoder = encoder(path)
        if not self.encoder.lower:
            raise ValueError("made for lower-case word vocabularies with removed white space")
        self.merges = Merges(path)
        letters = {bytes([byte]).decode("latin-1"): shown for byte, shown in byte_letters().items()}
        self.stand_in = str.maketrans(letters)
        self.known: dict[str, bytes | tuple[int, ...]] = {}
        self.special = regex.compile("|".join(map(regex.escape, self.encoder.specials)) or r"(?!)")

    def word(self, word: str) -> bytes | tuple[int, ...]:
        """The count at every prefix of a word, from one code point on.

        Any prefix but a whole contraction is a word of its own: "'r" of "'re" splits in two.
        """
        found = self.known.get(word)
        if found is None:
            if word[0] == "'" and len(word) > 1 and regex.fullmatch(CONTRACTIONS, word):
                parts = [WORDS.findall(word[:end]) for end in range(1, len(word) + 1)]
                found = [sum(self._dp(part)[-1] for part in each) for each in parts]
            else:
                found = self._dp(word)
            found = bytes(found) if max(found) < 256 else tuple(found)
            if len(self.known) < KEPT_WORDS:
                self.known[word] = found
        return found

    def _dp(self, word: str) -> list[int]:
        if word.isascii() and word.isprintable():  # no white space in words
            return self.merges.prefixes(word, list(range(1, len(word) + 1)))
        symbols = word.encode().decode("latin-1").translate(self.stand_in)
        if len(symbols) == len(word):
            return self.merges.prefixes(symbols, list(range(1, len(word) + 1)))
        ends, at = [], 0
        for letter in word:
            at += len(letter.encode())
            ends.append(at)
        return self.merges.prefixes(symbols, ends)

    def _segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text cut at special strings: (part, whether it is one)."""
        at = 0
        for match in self.special.finditer(text):
            yield text[at : match.start()], False
            yield match.group(), True
            at = match.end()
        yield text[at:], False

    def _words(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The normalised text, and (word, start, end) in it."""
        text = self.encoder.tokenizer.normalizer.normalize_str(text)
        split = self.encoder.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return text, [(text[a:b], a, b) for _, (a, b) in split]

    def total(self, text: str) -> int:
        """The count of the whole text."""
        if self.encoder.plain(text):
            known, count = self.known, 0
            for word in self.encoder.pattern.findall(text.lower()):
                found = known.get(word)
                count += found[-1] if found is not None else self.word(word)[-1]
            return count
        return sum(
            1 if special else sum(self.word(word)[-1] for word, _, _ in self._words(part)[1])
            for part, special in self._segments(text)
        )

    def table(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and its counts at prefixes of 0, 1, ... code points.

        A special string counts one token from its last code point on.
        """
        shown, counts = [], [np.zeros(1, np.int32)]
        before = 0
        for part, special in self._segments(text):
            if special:
                shown.append(part)
                counts.append(np.full(len(part), before, np.int32))
                before += 1
                counts[-1][-1] = before
                continue
            part, words = self._words(part)
            own = np.full(len(part), -1, np.int32)
            at = 0
            for word, start, end in words:
                own[at:start] = before
                own[start:end] = before + np.array(list(self.word(word)), np.int32)
                before, at = int(own[end - 1]), end
            own[at:] = before
            shown.append(part)
            counts.append(own)
        return "".join(shown), np.concatenate(counts)


@functools.lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than limit tokens).

    Null texts are empty: no bytes, no tokens. Ids may be null or repeat; other columns are unread.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(tokenizer)
        for batch in frames.shorter(batches):
            found = batch.column(1).to_pylist()
            tokens = np.array([known.total(text) for text in found], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(text.encode()) for text in found], pa.int64()),
                    pa.array(tokens),
                    pa.array(tokens > limit),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return frames.texts(docs).mapInArrow(count, schema)


def within_budget(docs: DataFrame, tokenizer: str, budget: int) -> DataFrame:
    """The longest prefix of each normalised text of at most budget tokens: doc_id, text, n_tokens.

    Counts are not monotone inside a word, so the last prefix that fits is looked up in the table.
    Null texts are empty.
    """
    schema = "doc_id long, text string, n_tokens long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(tokenizer)
        for batch in frames.shorter(batches):
            out, tokens = [], []
            for text in batch.column(1).to_pylist():
                shown, counts = known.table(text)
                end = int(np.flatnonzero(counts <= budget)[-1])
                out.append(shown[:end])
                tokens.append(int(counts[end]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.string()), pa.array(tokens, pa.int64())],
                names=["doc_id", "text", "n_tokens"],
            )

    return frames.texts(docs).mapInArrow(cut, schema)


def op10_prefix_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = frames.table(spark, folder, "documents")
    return token_counts(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)

"""Periodic runs against all periods of all stretches, tried one by one."""

import hashlib
import random
import re
import zlib

import pytest
from fixtures import frame, odd_rows

from wayfare.llm import periods


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def plain_runs(words, least_words=6, least_periods=4):
    found = []
    for q in range(1, len(words) // least_periods + 1):
        start = 0
        while start + q < len(words):
            if words[start] != words[start + q]:
                start += 1
                continue
            end = start + q
            while end < len(words) and words[end] == words[end - q]:
                end += 1
            if end - start >= max(least_words, least_periods * q):
                if smallest_period(words[start:end]) == q:
                    found.append((start, end - start, q))
            start = end - q + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(chance):
    """Nested repeats, with a wrong word here and there."""
    words = [bytes([97 + chance.randrange(3)]) for _ in range(chance.randrange(1, 4))]
    for _ in range(chance.randrange(1, 4)):
        words = words * chance.randrange(1, 7)
        if chance.random() < 0.6:
            words.insert(chance.randrange(len(words) + 1), bytes([97 + chance.randrange(4)]))
        if chance.random() < 0.4:
            words += [bytes([97 + chance.randrange(2)])] * chance.randrange(9)
        words = words[:160]
    return words


def test_runs_are_those_of_every_period():
    chance = random.Random(13)
    documents = [repetitive(chance) for _ in range(1200)]
    documents += [[bytes([97 + chance.randrange(2)]) for _ in range(chance.randrange(90))] for _ in range(600)]
    documents += [[], [b"a"], [b"a"] * 5, [b"a"] * 6, [b"a"] * 700, ([b"a"] * 14 + [b"b"]) * 5 + [b"a"] * 9]
    for first in range(0, len(documents), 50):  # several documents share an index
        part = documents[first : first + 50]
        for words, (count, runs, left) in zip(part, periods.runs_of([b" ".join(w) for w in part])):
            assert count == len(words)
            assert runs == plain_runs(words), words
            assert left == plain_collapsed(words, runs)


def test_more_periods_and_words_can_be_asked_for():
    words = [b"x", b"y"] * 5 + [b"z"] + [b"a"] * 7
    raw = [b" ".join(words)]
    assert [r for _, r, _ in periods.runs_of(raw, 8, 5)] == [plain_runs(words, 8, 5)]
    assert [r for _, r, _ in periods.runs_of(raw, 6, 6)] == [[(11, 7, 1)]]


def test_progressions_of_a_block():
    """A block of equal words stands many times in a window; the period ends at the odd word."""
    for q in (9, 13, 16, 31, 100):
        words = ([b"a"] * (q - 1) + [b"b"]) * 5
        assert (0, 5 * q, q) in next(periods.runs_of([b" ".join(words)]))[1]


def test_odd_documents(spark):
    rows = odd_rows() + [(50, "ab " * 600_000 + "x"), (51, "\x0bé\x0cé\té   é é é é é é é")]
    found = periods.word_runs(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    texts = sorted((str(i), t or "") for i, t in rows)
    for (key, text), row in zip(texts, sorted(found, key=lambda r: (str(r["doc_id"]), r["n_words"]))):
        if key not in ("4", "None"):
            words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
            assert row["n_words"] == len(words)
            if len(words) < 5000:
                assert [tuple(r) for r in row["runs"]] == plain_runs(words)
    long = next(r for r in found if r["doc_id"] == 50)
    assert [tuple(r) for r in long["runs"]] == [(0, 600_000, 1)] and long["collapsed"] == "ab x"
    assert periods.word_runs(frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        periods.word_runs(frame(spark, []), least_periods=3)


def rewritten(key, words):
    """The contract's rewriting of a tenth of the documents, word by word."""
    if key is None:
        return words
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_over_the_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = periods.op13_periodic_runs(spark, folder).collect()
    assert len(rows) == len(texts)
    compared = 0
    for row in rows:
        words = [w for w in re.split("[\x20\x09-\x0d]+", texts[row["doc_id"]] or "") if w]
        words = rewritten(row["doc_id"], words)
        if len(words) > 3000:
            continue
        compared += 1
        runs = plain_runs(words)
        shown = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        gone = {i for start, length, q in runs for i in range(start + q, start + length)}
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        milli = 1000 * best[1] // best[2] if runs else None
        assert tuple(row)[1:] == (
            len(runs), *best, milli,
            hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest(),
        )
    assert compared > 150 and any(r["n_runs"] for r in rows)

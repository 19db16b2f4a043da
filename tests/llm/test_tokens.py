"""Ids and counts against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fixtures import frame, odd_rows
from wayfare.llm import eliasfano, frames, packing, prefixcounts
from wayfare.llm.vocabulary import Encoder

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def texts():
    chance = random.Random(3)
    letters = "abcsrtlevdIS' \n\t.,!?0129é'ßÄ ÿĀſKʼn中<|>́²"
    return [t or "" for _, t in odd_rows()] + [
        "".join(chance.choice(letters) for _ in range(chance.randrange(50))) for _ in range(800)
    ]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_are_the_librarys(path):
    own, library = Encoder(path), Tokenizer.from_file(path)
    for text in texts():
        assert own.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_prefix_counts_are_exact():
    counter, library = prefixcounts.PrefixCounter(WORDS), Tokenizer.from_file(WORDS)
    for text in texts():
        assert counter.total(text) == len(library.encode(text, add_special_tokens=False).ids)
    for text in texts()[12:300]:
        if "<|" in text:
            continue
        shown, counts = counter.table(text)
        for end in range(len(shown) + 1):
            expected = len(library.encode(shown[:end], add_special_tokens=False).ids)
            assert counts[end] == expected, shown[:end]


def test_prefix_table_with_special_strings():
    counter = prefixcounts.PrefixCounter(WORDS)
    shown, counts = counter.table("a <|endoftext|> b")
    assert shown.endswith("b") and counts[-1] == 3 and (np.diff(counts) >= 0).all()


def test_counts_of_odd_documents(spark):
    rows = prefixcounts.token_counts(frame(spark, odd_rows()), WORDS, 2048).collect()
    library = Tokenizer.from_file(WORDS)
    expected = sorted(
        (i is None, i or 0, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
        for i, t in odd_rows()
    )
    assert expected == sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in rows)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in rows)
    assert prefixcounts.token_counts(frame(spark, []), WORDS, 5).collect() == []


def test_budget_cuts_at_the_last_prefix_that_fits(spark):
    rows = prefixcounts.within_budget(frame(spark, [(1, "one two three"), (2, None)]), WORDS, 2).collect()
    found = {r.doc_id: (r.text, r.n_tokens) for r in rows}
    assert found[2] == ("", 0) and found[1][0].startswith("one two") and found[1][1] == 2


def test_elias_fano_reads_what_was_packed():
    chance = random.Random(1)
    for count in (1, 2, 300, 1000):
        ends = np.cumsum([chance.choice([1, 1, 2, 900, 70_000]) for _ in range(count)])
        own = eliasfano.Ends(count, *eliasfano.pack_ends(ends))
        assert own.all().tolist() == ends.tolist()
        assert [own.select(k) for k in range(count)] == ends.tolist()
        size = sum(len(part) for part in eliasfano.pack_ends(ends)[1:3])
        assert size * 8 <= count * (2 + np.log2(max(1, ends[-1] / count)) + 1) + 16


@pytest.mark.parametrize("chunk_ids", [50, 1 << 20])
def test_files_give_back_every_document(spark, chunk_ids):
    target = frames.scratch(spark)
    docs = frame(spark, odd_rows())
    eliasfano.write_ids(docs, target, BYTES, chunk_ids=chunk_ids)
    chunks = eliasfano.read_ids(spark, target)
    library = Tokenizer.from_file(BYTES)
    start, expected = 0, []
    for i, t in sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = eliasfano.documents(chunks).orderBy("start").collect()
    assert [tuple(r) for r in found] == expected
    one = eliasfano.document_ids(chunks, 6).collect()
    assert [r.ids for r in one] == [library.encode(odd_rows()[9][1], add_special_tokens=False).ids + [0]]


def test_empty_file(spark):
    target = frames.scratch(spark)
    eliasfano.write_ids(frame(spark, []), target, BYTES)
    assert eliasfano.documents(eliasfano.read_ids(spark, target)).collect() == []


def test_fullest_is_as_full_as_any_combination():
    chance = random.Random(5)
    for _ in range(200):
        counts = {chance.randrange(1, 30): chance.randrange(1, 4) for _ in range(6)}
        sums = {0}
        longest = max(counts)
        for length, count in counts.items():
            for _ in range(count - (length == longest)):
                sums |= {s + length for s in sums if s + length <= 40 - longest}
        used = packing.fullest(counts, 40)
        assert sum(k * v for k, v in used.items()) == longest + max(sums)
        assert all(counts[k] >= v for k, v in used.items())


@pytest.mark.parametrize("capacity", [16, 2048])
def test_sequences_are_gapless_and_complete(spark, capacity):
    rows = packing.packed(frame(spark, odd_rows()), WORDS, capacity).collect()
    library = Tokenizer.from_file(WORDS)
    pieces = []
    for i, t in odd_rows():
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        pieces += [
            (i or -1, n, at, len(ids[at : at + capacity]), zlib.crc32(ids[at : at + capacity].tobytes()))
            for n, at in enumerate(range(0, len(ids), capacity))
        ]
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(pieces)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    lower = -(-sum(r.length for r in rows) // capacity)
    assert len(by_sequence) <= lower + 1
    assert packing.packed(frame(spark, []), WORDS).collect() == []

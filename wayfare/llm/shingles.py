"""Distinct word shingles of texts as 64-bit numbers, computed for many texts at once in numpy."""

from __future__ import annotations

import numpy as np

# Odd multipliers of a polynomial over bytes and over words, and of a final mix.
BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32



def times(a: np.uint64, b: np.uint64) -> np.uint64:
    return np.uint64(int(a) * int(b) & 0xFFFFFFFFFFFFFFFF)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """BYTE_BASE ** k and its inverse ** k modulo 2 ** 64, for k below count."""
    size = 1 << max(16, (count - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        inverse = np.uint64(pow(int(BYTE_BASE), -1, 1 << 64))
        own = []
        for base in (BYTE_BASE, inverse):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            own.append(np.multiply.accumulate(table))
        _powers[size] = (own[0], own[1])
    return _powers[size]


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * MIX[0]
    values = (values ^ (values >> np.uint64(27))) * MIX[1]
    return values ^ (values >> np.uint64(31))


def set_numbers(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A 64-bit number of every set, the same for equal sets in any order; 0 for empty ones."""
    sizes = np.diff(firsts)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(values + MIX[1]))])
    found = mixed((sums[firsts[1:]] - sums[firsts[:-1]]) ^ mixed(sizes.astype(np.uint64)))
    found[sizes == 0] = 0
    return found


def sorted_inside(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The values, ascending inside each text; in place."""
    for first, end in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        values[first:end].sort()
    return values


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts, number of words before each text and at the end).

    Words are runs of bytes other than blanks, A-Z lowered; texts are data[offsets[k]:offsets[k+1]].
    """
    ends_text = np.zeros(len(data) + 1, bool)
    ends_text[offsets] = True
    blank = SPACE[data]
    inside = ~blank
    before = np.concatenate([[True], blank])[:-1] | ends_text[:-1]
    starts = np.flatnonzero(inside & before)
    after = np.concatenate([blank[1:], [True]]) | ends_text[1:]
    ends = np.flatnonzero(inside & after) + 1
    forward, backward = powers(len(data) + 1)
    # The byte's value plus one, so that words of different lengths differ even if they hold zeros.
    terms = (LOWER[data].astype(np.uint64) + np.uint64(1)) * forward[: len(data)]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
    hashes = mixed((sums[ends] - sums[starts]) * backward[starts])
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles of every text, ascending inside each; where each text's begin, and the end).

    A text with fewer words, but not none, has its whole sequence as one shingle.
    """
    hashes, firsts = word_hashes(data, offsets)
    counts = np.diff(firsts)
    # One pass over all windows that lie in one text, then the short texts.
    total = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    scale = np.uint64(1)
    for k in range(words):
        total += hashes[k : len(hashes) - words + 1 + k] * scale
        scale = times(scale, WORD_BASE)
    owner = np.repeat(np.arange(len(counts)), counts)
    whole = owner[: len(total)] == owner[words - 1 :] if len(total) else np.zeros(0, bool)
    values, owners = mixed(total[whole]), owner[: len(total)][whole]
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        scale = np.uint64(1)
        for k in range(words - 1):
            own = np.flatnonzero(counts[short] > k)
            extra[own] += hashes[firsts[short[own]] + k] * scale
            scale = times(scale, WORD_BASE)
        extra = mixed(extra + counts[short].astype(np.uint64))
        values = np.concatenate([values, extra])
        owners = np.concatenate([owners, short])
        order = np.argsort(owners, kind="stable")
        values, owners = values[order], owners[order]
    values = sorted_inside(values, np.searchsorted(owners, np.arange(len(counts) + 1)))
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[new], owners[new]
    return values, np.searchsorted(owners, np.arange(len(counts) + 1))

"""The trie's nodes against prefixes kept as Python lists."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from wayfare.llm import prefixtrie

SCHEMA = "conv_id long, turn int, role string, text string, depth string, node int, last string"


def table(spark, rows):
    return spark.createDataFrame([(*row, "d", 1, "l") for row in rows], SCHEMA)


def plain_conversations(rows, lend=True):
    turns = {}
    for key, turn, role, text in rows:
        if key is not None:
            turns.setdefault(key, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    for own in turns.values():
        own.sort()
    original = {key: [(role, text) for _, _, role, text in own] for key, own in turns.items()}
    if not lend:
        return original
    out = {}
    for key, own in original.items():
        h = zlib.crc32(str(key).encode()) % 9
        lender = key - int(math.fmod(key, 5))  # as SQL has it for ids below 0
        out[key] = original.get(lender, [])[:h] + own[h:]
    return out


def plain_nodes(conversations):
    members = {}
    for key, own in conversations.items():
        for depth in range(len(own) + 1):
            members.setdefault(tuple(own[:depth]), []).append(key)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = children.get(prefix, [])
        leaves[prefix] = sum(leaves[x] for x in below) if below else 1
        own = (len(members[prefix]) - 1) * len(prefix[-1][1]) if prefix else 0
        saved[prefix] = own + sum(saved[x] for x in below)
    out = []
    for prefix, keys in members.items():
        ends = ",".join(str(k) for k in sorted(keys) if len(conversations[k]) == len(prefix))
        out.append(
            (
                min(keys), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(keys),
                len(children.get(prefix, [])), leaves[prefix], saved[prefix],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def found_nodes(frame):
    return sorted((tuple(r) for r in frame.drop("node").collect()), key=repr)


def conversations(seed, count, longest):
    """Few different turns, so that prefixes are shared; numbers have gaps, are null and are repeated."""
    chance = random.Random(seed)
    rows = []
    for key in range(count):
        if key % 10 == 5:
            continue  # a lender that is absent
        for turn in range(chance.randrange(1, longest)):
            text = chance.choice(["a", "a", "a", "bé", ""]) if turn < longest - 2 else f"own {key}"
            number = None if chance.random() < 0.1 else turn * 2 - chance.randrange(2)
            rows.append((key, number, chance.choice(["u", "u", "u", None]), text))
    rows += [(key, 0, "u", "a") for key in range(900, 960)]  # the very same
    rows += [(None, 0, "u", "a"), (None, None, None, None), (61, None, None, None), (61, None, None, None)]
    rows += [(70, 3, "u", "x" * 3_000_000), (71, 3, "ux", ""), (72, 3, "u", "x"), (-7, 1, "u", "a"), (-5, 1, "v", "b")]
    return rows


@pytest.mark.parametrize("height", [1, 2, 3, None])
def test_rebuilt_conversations(spark, height):
    rows = conversations(11, 60, 14)
    turns = prefixtrie.ordered_turns(table(spark, rows))
    found = found_nodes(prefixtrie.trie(prefixtrie.rebuilt(turns), height))
    assert found == plain_nodes(plain_conversations(rows))


def test_long_conversations_take_few_bands(spark):
    rows = [(key, turn, "u", "same" if turn < 90 else f"{key % 3}") for key in range(4) for turn in range(130)]
    rows += [(9, turn, "u", "same") for turn in range(200)]
    turns = prefixtrie.ordered_turns(table(spark, rows)).withColumn("part", F.lit(0))
    assert found_nodes(prefixtrie.trie(turns)) == plain_nodes(plain_conversations(rows, lend=False))


def test_crowded_parents(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "CROWDED", 3)
    monkeypatch.setattr(prefixtrie, "PIECE", 8)
    rows = [(key, 0, "u", "common") for key in range(80)]
    rows += [(key, 1, "u", f"{key % 40}") for key in range(80) if key % 3]
    turns = prefixtrie.ordered_turns(table(spark, rows)).withColumn("part", F.lit(0))
    assert found_nodes(prefixtrie.trie(turns)) == plain_nodes(plain_conversations(rows, lend=False))


def test_no_conversations(spark):
    turns = prefixtrie.ordered_turns(table(spark, [(None, 1, "u", "a")]))
    assert prefixtrie.trie(prefixtrie.rebuilt(turns)).collect() == []


def test_turnless_conversations(spark):
    """A conversation whose turns are all replaced by those of an absent lender is the root's."""
    key = next(k for k in range(1, 999) if k % 5 and zlib.crc32(str(k).encode()) % 9 > 1)
    rows = [(key, 0, "u", "a")]
    turns = prefixtrie.ordered_turns(table(spark, rows))
    found = prefixtrie.trie(prefixtrie.rebuilt(turns)).collect()
    assert [(r["conv_id"], r["depth"], r["n_convs"], r["n_leaves"]) for r in found] == [(key, 0, 1, 1)]
    assert found[0]["ends_sha256"] == hashlib.sha256(str(key).encode()).hexdigest()

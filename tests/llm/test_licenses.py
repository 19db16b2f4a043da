"""Licence findings against the words compared one by one, and expressions against truth by hand."""

import itertools
import random
import re

import pytest
from fixtures import frame, odd_rows, prose

from wayfare.llm import licenses
from wayfare.llm.licenses import COPYLEFT, NONCOMMERCIAL, PERMISSIVE, RESERVED, WEAK

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_places(text, phrases):
    words = WORDS.findall(lowered(text or ""))
    return len(words), sorted(
        (at, label)
        for phrase, label in phrases.items()
        for at in range(len(words))
        if words[at : at + len(phrase.split())] == phrase.split()
    )


def value(text, unlisted=False):
    steps, _ = licenses.postfix(text.encode(), 0, unlisted)
    return licenses.evaluated(steps)


@pytest.mark.parametrize(
    "text, terms, labels",
    [
        ("MIT", PERMISSIVE, {"mit"}),
        ("GPL-2.0-only OR MIT", PERMISSIVE, {"mit"}),
        ("GPL-2.0+", COPYLEFT, {"gpl-2.0-or-later"}),
        ("MIT AND Zlib", PERMISSIVE, {"mit", "zlib"}),
        ("MIT OR GPL-3.0-only AND CC-BY-NC-4.0", PERMISSIVE, {"mit"}),
        ("(MIT OR GPL-3.0-only) AND CC-BY-NC-4.0", NONCOMMERCIAL, {"mit", "cc-by-nc-4.0"}),
        ("GPL-3.0-only and cc-by-nc-4.0 or MPL-2.0", WEAK, {"mpl-2.0"}),
        ("GPL-2.0-only WITH Classpath-exception-2.0", WEAK, {"gpl-2.0-only with classpath-exception-2.0"}),
        ("MIT AND GPL-2.0 with Classpath-exception-2.0", WEAK, {"mit", "gpl-2.0 with classpath-exception-2.0"}),
        ("GPL-2.0-only WITH no-such-exception", COPYLEFT, {"gpl-2.0-only with no-such-exception"}),
        ("((MIT))", PERMISSIVE, {"mit"}),
        ("MIT.", PERMISSIVE, {"mit"}),
        ("MIT OR", PERMISSIVE, {"mit"}),
        ("MIT AND (", PERMISSIVE, {"mit"}),
        ("MIT AND (GPL-3.0-only OR", COPYLEFT, {"mit", "gpl-3.0-only"}),
        ("(MIT AND (GPL-3.0-only", COPYLEFT, {"mit", "gpl-3.0-only"}),
        ("MIT Copyright 2020", PERMISSIVE, {"mit"}),
        ("MIT) AND GPL-3.0-only", PERMISSIVE, {"mit"}),
        ("MIT or whatever", PERMISSIVE, {"mit"}),
        ("MIT WITH", PERMISSIVE, {"mit"}),
        ("MIT\nAND GPL-3.0-only", PERMISSIVE, {"mit"}),
    ],
)
def test_expressions(text, terms, labels):
    assert value(text) == (terms, frozenset(labels))


@pytest.mark.parametrize("text", ["", "see file", "OR MIT", ")", "()", "(", "with MIT", "and", "((("])
def test_no_expressions(text):
    assert value(text) is None


def test_unlisted_identifiers():
    assert value("LicenseRef-Own", True) == (RESERVED, frozenset(["unlisted"]))
    assert value("MIT AND LicenseRef-Own", True).terms == RESERVED
    assert value("MIT OR LicenseRef-Own", True) == (PERMISSIVE, frozenset(["mit"]))


def tree_value(tree):
    if isinstance(tree, str):
        return licenses.license_of(tree, False)
    left, right = tree_value(tree[1]), tree_value(tree[2])
    return licenses.combined(tree[0], left, right)


def tree_text(tree):
    return tree if isinstance(tree, str) else f"({tree_text(tree[1])} {tree[0]} {tree_text(tree[2])})"


def test_random_trees():
    chance = random.Random(4)
    names = sorted(licenses.LICENSES)

    def grown(depth):
        if depth == 0 or chance.random() < 0.2:
            return chance.choice(names)
        return (chance.choice(["and", "or"]), grown(depth - 1), grown(depth - 1))

    for _ in range(300):
        tree = grown(6)
        assert value(tree_text(tree)) == tree_value(tree)


def test_precedence_without_brackets():
    chance = random.Random(5)
    names = sorted(licenses.LICENSES)
    for _ in range(300):
        groups = [[chance.choice(names) for _ in range(chance.randrange(1, 4))] for _ in range(chance.randrange(1, 4))]
        text = " OR ".join(" AND ".join(group) for group in groups)
        every = [
            licenses.Terms(max(licenses.LICENSES[n] for n in group), frozenset(group)) for group in groups
        ]
        assert value(text) == min(every, key=lambda x: x.terms)


def test_long_expressions_take_linear_work():
    text = " AND ".join(["(MIT OR GPL-3.0-only)"] * 20_000)
    assert value(text) == (PERMISSIVE, frozenset(["mit"]))
    assert value("(" * 50_000 + "MIT" + ")" * 50_000) == (PERMISSIVE, frozenset(["mit"]))


def test_tags_in_texts():
    def found(text):
        return [(x.kind, x.labels, x.terms) for x in licenses.scan(text.encode())[1] if x.kind == "tag"]

    assert found("// SPDX-License-Identifier: Apache-2.0 OR MIT\nint x;") == [("tag", ("apache-2.0",), PERMISSIVE)]
    assert found('{"license": "GPL-3.0-only"}') == [("tag", ("gpl-3.0-only",), COPYLEFT)]
    assert found("license = 'MIT'") == [("tag", ("mit",), PERMISSIVE)]
    assert found("the license is kept in a file; license: see file") == []
    assert found("SPDX-License-Identifier: LicenseRef-1") == [("tag", ("unlisted",), RESERVED)]
    text = "é SPDX-License-Identifier: MIT\n"
    _, (hit,) = licenses.scan(text.encode())
    assert text.encode()[hit.start : hit.end].decode() == "SPDX-License-Identifier: MIT"


def test_notices_and_score():
    count, found = licenses.scan(b"Licensed under the Apache License, Version 2.0.")
    assert {x.labels[0] for x in found} == {"apache", "apache-2.0"}
    assert licenses.score_of([]) == 0.0
    one = licenses.score_of(found[:1])
    assert 0 < one < licenses.score_of(found) < 1


def test_documents_against_words_compared_one_by_one(spark):
    chance = random.Random(6)
    parts = ["CC BY", "cc-by-sa 4.0", "General  Public\nLicense", "all rights reserved", "cc by cc by", "GENERAL",
             "public", "license", "ⓒ", "İ", "by", "all rights", "reserved.", "under the MIT License"]
    rows = [
        (k, " ".join(itertools.chain.from_iterable([chance.choice(parts), *prose(k, 3)] for _ in range(chance.randrange(9)))))
        for k in range(100, 220)
    ]
    rows += odd_rows() + [(300, "x " * 1_000_000 + "All Rights Reserved"), (301, "cc" + "\x00" + "by")]
    docs = frame(spark, rows)
    found = licenses.licenses(docs).collect()
    assert len(found) == len(rows) and licenses.licenses(frame(spark, [])).collect() == []
    every = {phrase: label for phrase, (label, _) in licenses.NOTICES.items()}
    by_id = {}
    for key, text in rows:
        by_id.setdefault(key, []).append(text)
    for row in found:
        if len(by_id[row["doc_id"]]) > 1:
            continue
        text = by_id[row["doc_id"]][0]
        for kind, phrases in (("base", licenses.BASE), ("notice", every)):
            count, places = plain_places(text, phrases)
            assert row["n_words"] == count
            own = [x for x in row["findings"] if x["kind"] == kind]
            assert sorted((x["first"], x["labels"][0]) for x in own) == places
            for x in own:
                assert len(WORDS.findall(lowered(text[x["start"] : x["end"]]))) == x["words"]
        assert 0 <= row["score"] <= 1


def test_query_over_the_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = licenses.op12_licenses(spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        count, places = plain_places(texts[row["doc_id"]], licenses.BASE)
        starts = [at for at, _ in places]
        labels = ",".join(sorted({label for _, label in places}))
        assert (row["n_words"], row["n_base"], row["base_labels"]) == (count, len(places), labels)
        assert (row["first_word"], row["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
    assert any(row["n_base"] for row in rows) and any(row["labels"] != row["base_labels"] for row in rows)

"""Licence scan: one automaton for notices and identifier tags, and a shunting-yard parser for
licence expressions.

A text is normalised to its lower-case words with single spaces between, and scanned once in C for
notice phrases and for the words of identifier tags. Behind a tag the original text is read: the
licence expression there (`MIT OR (GPL-2.0-only WITH Classpath-exception-2.0 AND Zlib)`) is turned
into postfix order and evaluated. `or` takes the freer side, `and` both with the stricter terms, and
`with` an exception that softens the licence before it.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import frames
from wayfare.llm.decontaminate import WORD, words_of

#: Terms by rising restriction; a licence's terms are a place in this list.
TERMS = ("none", "permissive", "weak copyleft", "copyleft", "noncommercial", "reserved")
NONE, PERMISSIVE, WEAK, COPYLEFT, NONCOMMERCIAL, RESERVED = range(len(TERMS))

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_TERMS = {"cc-by": PERMISSIVE, "gpl": COPYLEFT, "reserved": RESERVED}

# Phrases of common notices with label and terms.
NOTICES = {
    "mit license": ("mit", PERMISSIVE),
    "permission is hereby granted free of charge to any person": ("mit", PERMISSIVE),
    "apache license": ("apache", PERMISSIVE),
    "apache license version 2 0": ("apache-2.0", PERMISSIVE),
    "bsd license": ("bsd", PERMISSIVE),
    "redistribution and use in source and binary forms": ("bsd", PERMISSIVE),
    "isc license": ("isc", PERMISSIVE),
    "permission to use copy modify and or distribute this software": ("isc", PERMISSIVE),
    "boost software license": ("bsl-1.0", PERMISSIVE),
    "zlib license": ("zlib", PERMISSIVE),
    "creative commons attribution": ("cc-by-notice", PERMISSIVE),
    "creative commons zero": ("cc0-1.0", PERMISSIVE),
    "cc0 1 0": ("cc0-1.0", PERMISSIVE),
    "released into the public domain": ("public-domain", PERMISSIVE),
    "dedicated to the public domain": ("public-domain", PERMISSIVE),
    "mozilla public license": ("mpl", WEAK),
    "eclipse public license": ("epl", WEAK),
    "lesser general public license": ("lgpl", WEAK),
    "affero general public license": ("agpl", COPYLEFT),
    "cc by sa": ("cc-by-sa", COPYLEFT),
    "creative commons attribution sharealike": ("cc-by-sa", COPYLEFT),
    "cc by nc": ("cc-by-nc", NONCOMMERCIAL),
    "cc by nc sa": ("cc-by-nc-sa", NONCOMMERCIAL),
    "cc by nc nd": ("cc-by-nc-nd", NONCOMMERCIAL),
    "creative commons attribution noncommercial": ("cc-by-nc", NONCOMMERCIAL),
    "cc by nd": ("cc-by-nd", RESERVED),
    "proprietary and confidential": ("proprietary", RESERVED),
    "unauthorized copying of this file": ("proprietary", RESERVED),
    "may not be reproduced without": ("proprietary", RESERVED),
}

# Published short identifiers and their terms, without "-only", "-or-later" and "+".
LICENSES = {
    "0bsd": PERMISSIVE, "afl-3.0": PERMISSIVE, "apache-1.1": PERMISSIVE, "apache-2.0": PERMISSIVE,
    "artistic-2.0": PERMISSIVE, "bsd-2-clause": PERMISSIVE, "bsd-3-clause": PERMISSIVE,
    "bsl-1.0": PERMISSIVE, "cc-by-3.0": PERMISSIVE, "cc-by-4.0": PERMISSIVE, "cc0-1.0": PERMISSIVE,
    "isc": PERMISSIVE, "mit": PERMISSIVE, "mit-0": PERMISSIVE, "ncsa": PERMISSIVE,
    "postgresql": PERMISSIVE, "psf-2.0": PERMISSIVE, "python-2.0": PERMISSIVE, "unlicense": PERMISSIVE,
    "upl-1.0": PERMISSIVE, "wtfpl": PERMISSIVE, "x11": PERMISSIVE, "zlib": PERMISSIVE,
    "cddl-1.0": WEAK, "epl-1.0": WEAK, "epl-2.0": WEAK, "lgpl-2.0": WEAK, "lgpl-2.1": WEAK,
    "lgpl-3.0": WEAK, "mpl-1.1": WEAK, "mpl-2.0": WEAK, "ms-pl": WEAK,
    "agpl-3.0": COPYLEFT, "cc-by-sa-3.0": COPYLEFT, "cc-by-sa-4.0": COPYLEFT, "eupl-1.2": COPYLEFT,
    "gpl-1.0": COPYLEFT, "gpl-2.0": COPYLEFT, "gpl-3.0": COPYLEFT, "osl-3.0": COPYLEFT,
    "cc-by-nc-4.0": NONCOMMERCIAL, "cc-by-nc-sa-4.0": NONCOMMERCIAL, "cc-by-nc-nd-4.0": NONCOMMERCIAL,
    "polyform-noncommercial-1.0.0": NONCOMMERCIAL,
    "busl-1.1": RESERVED, "cc-by-nd-4.0": RESERVED, "sspl-1.0": RESERVED,
}
EXCEPTIONS = (
    "autoconf-exception-3.0", "bison-exception-2.2", "classpath-exception-2.0",
    "font-exception-2.0", "gcc-exception-3.1", "linux-syscall-note", "llvm-exception",
    "openssl-exception", "swift-exception",
)

#: Tags by their words: whether an unlisted identifier behind them is a licence all the same.
TAGS = {"spdx license identifier": True, "license expression": False, "license": False, "licence": False}
#: What may stand between a tag and its expression.
OPENING = re.compile(rb"[\"']?[\x20\t]*[:=][\x20\t]*[\"']?")
TOKEN = re.compile(rb"[\x20\t]*(?:([()])|([0-9A-Za-z][0-9A-Za-z.+:-]*))")
STRENGTH = {"with": 3, "and": 2, "or": 1}

#: Weights of evidence: an evaluated expression, a phrase of five or more words, a shorter one.
BY_TAG, BY_NOTICE, BY_PHRASE = 0.9, 0.7, 0.5


class Terms(NamedTuple):
    """What an expression comes to: terms, and the licences that they come from."""

    terms: int
    labels: frozenset[str]


def license_of(name: str, unlisted: bool) -> Terms | None:
    plain = name.removesuffix("+").removesuffix("-only").removesuffix("-or-later")
    if plain in LICENSES:
        return Terms(LICENSES[plain], frozenset([name.replace("+", "-or-later")]))
    return Terms(RESERVED, frozenset(["unlisted"])) if unlisted else None


def combined(operator: str, left: Terms, right: Terms) -> Terms:
    if operator == "or":
        return left if left.terms <= right.terms else right
    return Terms(max(left.terms, right.terms), left.labels | right.labels)


def softened(licence: Terms, exception: str) -> Terms:
    terms = WEAK if licence.terms == COPYLEFT and exception in EXCEPTIONS else licence.terms
    return Terms(terms, frozenset(f"{label} with {exception}" for label in licence.labels))


def postfix(raw: bytes, at: int, unlisted: bool) -> tuple[list, int]:
    """The expression from `at` on in postfix order, and where it ends.

    Operands are Terms, operators ("and" | "or"), exceptions ("with", name). The expression ends at
    the end of the line, at other characters, at an operand where an operator must stand, at an
    identifier that is no licence, and where a bracket closes that none opened. An operator without a
    right side is not part of it, and brackets still open are closed.
    """
    out: list = []
    waiting: list[str] = []  # operators and opening brackets
    operand = True  # one must come next
    end = at
    pending_with = False

    def settle(strength: int) -> None:
        while waiting and waiting[-1] != "(" and STRENGTH[waiting[-1]] >= strength:
            out.append(waiting.pop())

    while match := TOKEN.match(raw, at):
        bracket, word = match[1], match[2]
        name = word.decode("ascii").lower() if word else ""
        if pending_with:
            if not word or name in STRENGTH:
                break
            out.append(("with", name.rstrip(".:")))
            pending_with = False
        elif operand:
            if bracket == b"(":
                waiting.append("(")
                at = match.end()
                continue
            if not word or name in STRENGTH:
                break
            found = license_of(name.rstrip(".:"), unlisted)
            if found is None:
                break
            out.append(found)
            operand = False
        elif bracket == b")":
            settle(0)
            if not waiting:
                break
            waiting.pop()
        elif name in ("and", "or"):
            settle(STRENGTH[name])
            waiting.append(name)
            operand = True
            at = match.end()
            continue
        elif name == "with" and isinstance(out[-1], Terms):
            pending_with = True  # binds to the licence just read, before any other operator
            at = match.end()
            continue
        else:
            break
        at = end = match.end()
    # What waits for a right side that did not come is dropped with the brackets opened behind it.
    while operand and waiting:
        if waiting.pop() != "(":
            break
    settle(0)
    while waiting:
        waiting.pop()  # a bracket left open
        settle(0)
    return out, end


def evaluated(steps: list) -> Terms | None:
    """The value of a postfix expression, none if it is empty."""
    values: list[Terms] = []
    for step in steps:
        if isinstance(step, Terms):
            values.append(step)
        elif isinstance(step, tuple):
            values.append(softened(values.pop(), step[1]))
        else:
            right, left = values.pop(), values.pop()
            values.append(combined(step, left, right))
    return values[0] if values else None


@functools.cache
def phrases() -> ahocorasick.Automaton:
    """Phrase with a space around -> (length, words, what it stands for)."""
    own: dict[str, list[tuple]] = {}
    for phrase, label in BASE.items():
        own.setdefault(phrase, []).append(("base", label, BASE_TERMS[label]))
    for phrase, (label, terms) in NOTICES.items():
        own.setdefault(phrase, []).append(("notice", label, terms))
    for phrase, unlisted in TAGS.items():
        own.setdefault(phrase, []).append(("tag", unlisted, 0))
    machine = ahocorasick.Automaton()
    for phrase, uses in own.items():
        machine.add_word(f" {phrase} ", (phrase.count(" ") + 1, uses))
    machine.make_automaton()
    return machine


class Finding(NamedTuple):
    """A phrase, or a tag with its expression, in word numbers and byte offsets."""

    first: int
    words: int
    start: int
    end: int
    kind: str
    labels: tuple[str, ...]
    terms: int


def scan(raw: bytes) -> tuple[int, list[Finding]]:
    """The number of words, and the findings by place.

    Of tags that end at the same word only the longest is read.
    """
    words = words_of(raw)
    text = b" " + b" ".join(words) + b" "
    hits = list(phrases().iter(text.decode("latin-1"))) if words else []
    if not hits:
        return len(words), []
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
    ends = np.searchsorted(spaces, [place for place, _ in hits]).tolist()
    places = [match.span() for match in WORD.finditer(raw)]
    found, read = [], set()
    for last, (_, (count, uses)) in sorted(zip(ends, hits), key=lambda x: (x[0], -x[1][1][0])):
        first = last - count
        start, end = places[first][0], places[last - 1][1]
        for kind, label, terms in uses:
            if kind != "tag":
                found.append(Finding(first, count, start, end, kind, (label,), terms))
            elif last not in read:
                read.add(last)
                if opening := OPENING.match(raw, end):
                    steps, stop = postfix(raw, opening.end(), label)
                    if value := evaluated(steps):
                        found.append(
                            Finding(first, count, start, stop, kind, tuple(sorted(value.labels)), value.terms)
                        )
    return len(words), sorted(found)


def score_of(found: list[Finding]) -> float:
    """How surely the text carries licence terms: 1 less the product of the doubts that are left by
    the strongest evidence of each label."""
    best: dict[str, float] = {}
    for x in found:
        weight = BY_TAG if x.kind == "tag" else BY_NOTICE if x.words >= 5 else BY_PHRASE
        for label in x.labels:
            best[label] = max(best.get(label, 0.0), weight)
    doubt = 1.0
    for label in sorted(best):
        doubt *= 1.0 - best[label]
    return round(1.0 - doubt, 9)


FINDINGS = "array<struct<first:int,words:int,start:int,end:int,kind:string,labels:array<string>,terms:string>>"
FINDING_TYPE = pa.list_(
    pa.struct(
        [
            ("first", pa.int32()), ("words", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
            ("kind", pa.string()), ("labels", pa.list_(pa.string())), ("terms", pa.string()),
        ]
    )
)


def licenses(docs: DataFrame) -> DataFrame:
    """The licence notices and expressions of every whole text.

    One row per document: doc_id, n_words, findings (kind `base`, `notice` or `tag`; first word and
    number of words, from 0; start and end in code points, a tag's with its expression; labels; terms),
    terms (the strictest found, `none` without findings) and score (0 to 1, see :func:`score_of`).
    Null texts are empty and have no findings; ids may be null or repeat; other columns are not read; an
    empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames.shorter(batches):
            counts, shown, terms, scores = [], [], [], []
            for raw in frames.raw_column(batch.column(1)):
                count, found = scan(raw)
                flat = frames.code_points(raw, [place for x in found for place in (x.start, x.end)])
                counts.append(count)
                shown.append(
                    [
                        (x.first, x.words, flat[2 * k], flat[2 * k + 1], x.kind, x.labels, TERMS[x.terms])
                        for k, x in enumerate(found)
                    ]
                )
                terms.append(TERMS[max((x.terms for x in found), default=NONE)])
                scores.append(score_of(found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(shown, FINDING_TYPE),
                    pa.array(terms, pa.string()),
                    pa.array(scores, pa.float64()),
                ],
                names=["doc_id", "n_words", "findings", "terms", "score"],
            )

    return frames.texts(docs).mapInArrow(
        run, f"doc_id long, n_words long, findings {FINDINGS}, terms string, score double"
    )


def op12_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses(frames.table(spark, folder, "documents"))
    base = F.filter("findings", lambda x: x["kind"] == "base")

    def listed(findings: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.flatten(F.transform(findings, lambda x: x["labels"])))), ",")

    return found.withColumn("base", base).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["first"])).cast("long").alias("last_word"),
        listed(F.col("base")).alias("base_labels"),
        listed(F.col("findings")).alias("labels"),
        "score",
        "terms",
    )

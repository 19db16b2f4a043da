"""Secret scanning: Aho-Corasick keyword prefilter, anchored expressions, embedded checksums.

One automaton over all keywords scans the text once; an expression is only tried where its keyword
was found. Runs of hexadecimal digits have no keyword and are searched for directly. Beside the base
kinds, secrets that carry their own check are reported if it holds:

* `github`, `npm`: 36 characters whose last six are the base-62 CRC-32 of those before;
* `jwt`: three base64url parts, the first a JSON object with `alg`;
* `pem`: a private key block whose DER length equals that of its payload.
"""

from __future__ import annotations

import base64
import binascii
import functools
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from wayfare.llm import frames
from wayfare.llm.spans import Span, digest, in_code_points, listed

# The kinds in their order, and the published shapes of the secrets.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
ASSIGN, ACCESS, HEX, GITHUB, NPM, JWT, PEM = range(7)
KEYWORDS = {
    "password": ASSIGN,
    "passwd": ASSIGN,
    "secret": ASSIGN,
    "token": ASSIGN,
    "apikey": ASSIGN,
    "api_key": ASSIGN,
    "akia": ACCESS,
    "ghp_": GITHUB,
    "gho_": GITHUB,
    "ghu_": GITHUB,
    "ghs_": GITHUB,
    "ghr_": GITHUB,
    "npm_": NPM,
    "eyj": JWT,
    "-----begin": PEM,
}
EXPRESSIONS = {
    ASSIGN: re.compile(
        rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        re.IGNORECASE,
    ),
    ACCESS: re.compile(rb"AKIA[A-Z0-9]+"),
    GITHUB: re.compile(rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    NPM: re.compile(rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    JWT: re.compile(rb"(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)"),
    PEM: re.compile(
        rb"-----BEGIN ((?:[A-Z]+ )?PRIVATE KEY)-----\s([A-Za-z0-9+/=\s]+)-----END \1-----"
    ),
}
HEX_RUN = re.compile(rb"[0-9a-f]{24,}")
BASE_62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
LOWER = bytes(byte + 32 if 0x41 <= byte <= 0x5A else byte for byte in range(256))


def base_62(number: int, width: int) -> str:
    out = ""
    for _ in range(width):
        number, digit = divmod(number, 62)
        out = BASE_62[digit] + out
    return out


def checksum_holds(match: re.Match) -> bool:
    return base_62(zlib.crc32(match[1]), 6).encode() == match[2]


def header_holds(match: re.Match) -> bool:
    try:
        part = match[1] + b"=" * (-len(match[1]) % 4)
        found = json.loads(base64.urlsafe_b64decode(part))
    except (ValueError, RecursionError):
        return False
    return isinstance(found, dict) and "alg" in found


def length_holds(match: re.Match) -> bool:
    """The payload is one DER sequence whose stated length reaches exactly to its end."""
    try:
        payload = base64.b64decode(b"".join(match[2].split()), validate=True)
    except (binascii.Error, ValueError):
        return False
    if len(payload) < 2 or payload[0] != 0x30:
        return False
    if payload[1] < 0x80:
        return len(payload) == 2 + payload[1]
    width = payload[1] - 0x80
    stated = int.from_bytes(payload[2 : 2 + width], "big")
    return 0 < width <= 4 and len(payload) == 2 + width + stated


CHECKS = {
    ASSIGN: lambda match: len(match[2]) >= 6,
    ACCESS: lambda match: match.end() - match.start() >= 20,
    GITHUB: checksum_holds,
    NPM: checksum_holds,
    JWT: header_holds,
    PEM: length_holds,
}


@functools.cache
def keywords() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        machine.add_word(word, (len(word), kind))
    machine.make_automaton()
    return machine


def scan(raw: bytes) -> list[Span]:
    """The secrets of a text as byte spans.

    Spans of one kind do not overlap: the leftmost match is taken, and counts as taken even if its
    check fails.
    """
    hits = [
        (end + 1 - size, kind)
        for end, (size, kind) in keywords().iter(raw.translate(LOWER).decode("latin-1"))
    ]
    found = [(match.start(), match.end(), HEX) for match in HEX_RUN.finditer(raw)]
    done = [0] * len(KINDS)
    for start, kind in sorted(hits):
        if start >= done[kind] and (match := EXPRESSIONS[kind].match(raw, start)):
            done[kind] = match.end()
            if CHECKS[kind](match):
                found.append((start, match.end(), kind))
    return found


def secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, text, spans array<struct<start,end,kind>> in code points.

    kind is a name. Null texts are empty and have no spans; ids may be null or repeat; other columns
    are not read.
    """
    schema = "doc_id long, text string, spans array<struct<start:int,end:int,kind:string>>"
    kind_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames.shorter(batches):
            spans = [
                [(start, end, KINDS[kind]) for start, end, kind in sorted(in_code_points(raw, scan(raw)))]
                for raw in frames.raw_column(batch.column(1))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(spans, kind_type)],
                names=["doc_id", "text", "spans"],
            )

    return frames.texts(docs).mapInArrow(run, schema)


def secret_digests(docs: DataFrame) -> DataFrame:
    """Counts and digests of the base kinds, and all spans as text, from the same scan."""
    schema = (
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames.shorter(batches):
            counts, shown, everything = [], [], []
            for raw in frames.raw_column(batch.column(1)):
                spans = in_code_points(raw, scan(raw))
                base = [span for span in spans if span[2] <= HEX]
                counts.append([sum(span[2] == kind for span in base) for kind in range(3)])
                shown.append(digest(listed(base, KINDS)))
                everything.append(listed(spans, KINDS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array([count[kind] for count in counts], pa.int64()) for kind in range(3)),
                    pa.array(shown, pa.string()),
                    pa.array(everything, pa.string()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return frames.texts(docs).mapInArrow(run, schema)


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_digests(frames.table(spark, folder, "documents"))

"""Spans of a text as (start, end, kind number), and their digest columns."""

from __future__ import annotations

import hashlib

Span = tuple[int, int, int]


def in_code_points(raw: bytes, spans: list[Span]) -> list[Span]:
    """Byte spans of a UTF-8 text as code point spans."""
    if not spans or raw.isascii():
        return spans
    if len(spans) <= 8:  # a few counts are cheaper than a table
        return [
            (len(raw[:start].decode()), len(raw[:end].decode()), kind) for start, end, kind in spans
        ]
    from wayfare.llm.frames import code_points

    flat = code_points(raw, [place for start, end, _ in spans for place in (start, end)])
    return [(flat[2 * k], flat[2 * k + 1], kind) for k, (_, _, kind) in enumerate(spans)]


def listed(spans: list[Span], kinds: tuple[str, ...]) -> str:
    """kind:start:end by start, then kind, comma-joined."""
    order = sorted(spans, key=lambda span: (span[0], span[2], span[1]))
    return ",".join(f"{kinds[kind]}:{start}:{end}" for start, end, kind in order)


def digest(shown: str) -> str:
    return hashlib.sha256(shown.encode()).hexdigest()

"""Encoding with public tokenizer files, word by word where that gives the library's own ids.

The splitters of the two known layouts are applied here with `re`, and each distinct word is encoded
once per worker by the library's BPE model. A text with a character outside the ranges below, or
with a special string inside, is given to the library whole, so ids always equal the library's.
"""

from __future__ import annotations

import array
import functools
import json
import re

import numpy as np
from tokenizers import Tokenizer

# The characters up to U+024F by class, as Unicode has them; control characters,
# U+0080 to U+00A0 and the one letter whose lower case has two characters are left to the library.
UPPER_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
LOWER_LETTERS = "a-zªµºß-öø-ɏ"
NUMBERS = "0-9²³¹¼½¾"
BLANK = " \t\n\r"
PLAIN = re.compile(r"[\t\n\r -~¡-įı-ɏ]*")
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"

BYTE_WORDS = re.compile(
    rf"{CONTRACTIONS}| ?[{UPPER_LETTERS}]+| ?[{NUMBERS}]+| ?[^{BLANK}{UPPER_LETTERS}{NUMBERS}]+"
    rf"|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
)
LOWER_WORDS = re.compile(
    rf"{CONTRACTIONS}|[{LOWER_LETTERS}]+|[{NUMBERS}]|[^{BLANK}{LOWER_LETTERS}{NUMBERS}]+"
)

#: Words that a worker keeps; later ones are encoded each time they occur.
KEPT_WORDS = 200_000


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte: printable ones stay, the others follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {byte: chr(byte) for byte in shown} | {
        byte: chr(0x100 + place) for place, byte in enumerate(hidden)
    }


class Words(dict):
    """From a word to its ids as bytes; unknown ones are encoded by the model."""

    def __init__(self, model, width: np.dtype):
        super().__init__()
        self.model, self.code = model, {2: "H", 4: "I"}[width.itemsize]
        self.stand_in = {bytes([k]).decode("latin-1"): v for k, v in byte_letters().items()}
        self.latin = str.maketrans(self.stand_in)

    def __missing__(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():
            letters = word
        else:
            letters = word.encode().decode("latin-1").translate(self.latin)
        ids = [token.id for token in self.model.tokenize(letters)]
        found = array.array(self.code, ids).tobytes()
        if len(self) < KEPT_WORDS:
            self[word] = found
        return found


class Encoder:
    """ids(text) equals the library's encode(text, add_special_tokens=False).ids."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.specials = [token["content"] for token in layout["added_tokens"]]
        self.lower, self.pattern = layout_of(layout)
        self.words = Words(self.tokenizer.model, self.width)

    def plain(self, text: str) -> bool:
        return (
            self.pattern is not None
            and PLAIN.fullmatch(text) is not None
            and not any(special in text for special in self.specials)
        )

    def packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned integers of the encoder's width."""
        if self.plain(text):
            split = self.pattern.findall(text.lower() if self.lower else text)
            return b"".join(map(self.words.__getitem__, split))
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.width).tobytes()

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), self.width)


def layout_of(layout: dict) -> tuple[bool, re.Pattern | None]:
    """Whether to lower, and the splitter, of a known layout; (False, None) for any other."""
    before, split = layout.get("normalizer"), layout.get("pre_tokenizer") or {}
    model = layout["model"]
    if model.get("type") != "BPE" or model.get("dropout") or model.get("unk_token"):
        return False, None
    if before is None and split.get("type") == "ByteLevel":
        if split.get("use_regex") and not split.get("add_prefix_space"):
            return False, BYTE_WORDS
    kinds = [part.get("type") for part in (before or {}).get("normalizers", [])]
    parts = split.get("pretokenizers", [])
    if kinds == ["NFC", "Replace", "Lowercase"] and len(parts) == 2:
        known = rf"{CONTRACTIONS}|[\p{{L}}]+|[\p{{N}}]|[^\s\p{{L}}\p{{N}}]+"
        if parts[0].get("pattern") == {"Regex": known} and parts[0].get("invert"):
            if parts[1].get("type") == "ByteLevel" and not parts[1].get("use_regex"):
                return True, LOWER_WORDS
    return False, None


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker and file."""
    return Encoder(path)

"""Inputs and plain helpers shared by the tests of the training-data operators."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def word_list(text: str | None) -> list[str]:
    return WORD.findall(lower(text or ""))


# Ids and texts that every operator has to stand.
ODD = [
    (None, None),
    (1, None),
    (2, ""),
    (3, ""),
    (4, "..., !"),
    (4, "..., !"),
    (5, "one"),
    (5, "another text under the same id"),
    (6, "ÀÉ ß 12 x\x00y 漢字 emoji 🙂 end"),
    (7, "long " * 60_000),
    (8, "long " * 60_000),
    (None, "no id but text"),
    (None, "no id but text"),
]

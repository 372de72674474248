"""Whole batches of texts as arrays of code points, for features computed by numpy."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np

UPPER, LOWER, DIGIT, SPACE, SIGN = 1, 2, 3, 4, 0
TOP = 0x10000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    kinds, lower = np.zeros(TOP + 1, dtype=np.uint8), np.arange(TOP + 1, dtype=np.uint32)
    for i in range(TOP):
        if 0xD800 <= i < 0xE000:
            continue
        c = chr(i)
        if c.isspace():
            kinds[i] = SPACE
        elif c.isalpha() or unicodedata.category(c).startswith("M"):
            kinds[i] = UPPER if c.isupper() else LOWER
            if len(c.lower()) == 1:
                lower[i] = ord(c.lower())
        elif c.isdigit():
            kinds[i] = DIGIT
    kinds[TOP] = LOWER  # letters beyond the basic plane count as such, all as one
    return kinds, lower


_TABLES: list[tuple[np.ndarray, np.ndarray]] = []


def tables() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case by code point; those beyond the basic plane are found under ``TOP``."""
    if not _TABLES:
        _TABLES.append(_tables())
    return _TABLES[0]


def points(text: str) -> np.ndarray:
    codec = "utf-32-le" if sys.byteorder == "little" else "utf-32-be"
    return np.minimum(np.frombuffer(text.encode(codec, "replace"), dtype=np.uint32), TOP)


def runs(texts: list[str | None], chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of a list with about so many characters each, one text at least."""
    start = held = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and held + n > chars:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)

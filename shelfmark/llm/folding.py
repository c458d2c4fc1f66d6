"""Texts as code points with everything but letters and digits folded away."""

from __future__ import annotations

import sys
import unicodedata

import numpy as np

_table: np.ndarray | None = None


def _fold_table() -> np.ndarray:
    """Folded character of every code point; 32 for what separates."""
    table = np.full(sys.maxunicode + 1, 32, np.uint32)
    for c in range(sys.maxunicode):
        if 0xD800 <= c < 0xE000:
            continue
        s = chr(c)
        if s.isalnum():
            table[c] = ord(s.lower()[0])
        elif unicodedata.category(s)[0] == "M":
            table[c] = c
    table[sys.maxunicode] = sys.maxunicode
    return table


def fold(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters, and where each stands in ``text``."""
    global _table
    if _table is None:
        _table = _fold_table()
    codes = _table[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    keep = codes != 32
    if len(codes):
        keep[1:] |= codes[:-1] != 32
    where = np.flatnonzero(keep)
    if len(where) and codes[where[-1]] == 32:
        where = where[:-1]
    return codes[where], where

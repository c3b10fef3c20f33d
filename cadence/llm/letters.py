"""Texts as sequences of lower-case letters with one boundary (symbol 0) between words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_TABLE = 0x20000


@lru_cache(maxsize=1)
def _lower_table() -> np.ndarray:
    """Code point -> lower-case letter, 0 if it is no letter (below ``_TABLE``)."""
    table = np.zeros(_TABLE, np.uint32)
    for c in range(_TABLE):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _letters_of(code: np.ndarray) -> np.ndarray:
    table = _lower_table()
    far = code >= _TABLE
    if not far.any():
        return table[code]
    out = table[np.where(far, 0, code)]
    rare = np.unique(code[far])
    keep = np.array([chr(int(c)).isalpha() for c in rare])
    at = np.searchsorted(rare, code[far])
    out[far] = np.where(keep[at], code[far], 0)
    return out


def letter_sequence(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, first): text i is ``symbols[first[i]:first[i + 1]]``, which reads
    0 w o r d 0 w o r d 0 (a lone 0 without letters). Neighbouring texts don't share
    their boundary symbols."""
    code = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = (data & 0xC0) != 0x80
    starts = np.concatenate(([0], np.cumsum(lead, dtype=np.int64)))[off] if len(data) else np.zeros(len(off), np.int64)
    if len(code) != (starts[-1] if len(starts) else 0):  # bytes that are no UTF-8: text by text
        parts = [np.frombuffer(data[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                 for a, b in zip(off[:-1] - off[0], off[1:] - off[0])]
        code = np.concatenate(parts) if parts else code
        starts = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    n = len(starts) - 1
    sym = _letters_of(code)
    flat = np.zeros(len(sym) + 2 * n, np.uint32)  # a boundary before and after each text
    for i in range(n):
        a, b = int(starts[i]), int(starts[i + 1])
        flat[a + 2 * i + 1:b + 2 * i + 1] = sym[a:b]
    edge = starts + 2 * np.arange(n + 1)
    drop = np.zeros(len(flat), bool)
    drop[1:] = (flat[1:] == 0) & (flat[:-1] == 0)
    drop[edge[:-1]] = False
    kept = np.concatenate(([0], np.cumsum(~drop, dtype=np.int64)))
    return flat[~drop], kept[edge]


def symbol_stretches(data: np.ndarray, overlap: int, stretch: int) -> Iterator[np.ndarray]:
    """The symbols of one text in pieces made of about ``stretch`` bytes each; a piece
    begins with the ``overlap`` last symbols before it, so that windows of ``overlap`` + 1
    symbols lie in exactly one piece (pieces with fewer are handed on to the next; the
    last may be as short)."""
    held, fresh, lo, last = np.zeros(0, np.uint32), False, 0, -1
    while lo < len(data):
        hi = min(lo + stretch, len(data))
        while hi < len(data) and data[hi] & 0xC0 == 0x80:  # a code point is never cut
            hi += 1
        sym, _ = letter_sequence(data[lo:hi], np.array([0, hi - lo]))
        if lo and len(sym) and data[lo:lo + 4].tobytes().decode("utf-8", "ignore")[:1].isalpha():
            sym = sym[1:]  # the boundary in front isn't the text's
        if hi < len(data) and len(sym) and data[max(lo, hi - 4):hi].tobytes().decode("utf-8", "ignore")[-1:].isalpha():
            sym = sym[:-1]
        if len(sym) and last == 0 and sym[0] == 0:
            sym = sym[1:]
        if len(sym):
            fresh, last = True, int(sym[-1])
        held, lo = np.concatenate((held, sym)), hi
        if len(held) > overlap and fresh:
            yield held
            held, fresh = held[len(held) - overlap:], False
    if fresh:
        yield held

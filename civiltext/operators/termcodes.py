"""N-grams of many texts at once, as 64-bit codes over the bytes of an Arrow column.

A text is its tokens with one blank between them, so an n-gram is a stretch of its bytes. Codes
are computed for a whole batch by numpy; terms with equal codes are taken for equal.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
PIECE_BYTES = 1 << 20       # of texts coded together; a longer one is coded alone


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each text starts and ends; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, ends, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array):
    """Cut a column so that the texts of a piece have ``PIECE_BYTES``, or are a single text."""
    _, offsets = _bytes_of(column)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + PIECE_BYTES, side="right")) - 1
        stop = min(len(column), max(start + 1, stop))
        yield column.slice(start, stop - start)
        start = stop


@dataclass
class Grams:
    """All n-grams of a piece: their text, their code, and the bytes they are."""

    row: np.ndarray
    code: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray

    def strings(self, which: np.ndarray) -> pa.Array:
        """The n-grams numbered ``which`` as strings."""
        start, size = self.start[which], (self.end - self.start)[which]
        ends = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(ends[-1]) + np.repeat(start - ends[:-1], size)
        return pa.LargeStringArray.from_buffers(
            len(which), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(self.data[place]))


def grams(column: pa.Array, ngrams: tuple[int, int]) -> Grams:
    """N-grams of texts whose tokens stand with one blank between them."""
    data, offsets = _bytes_of(column)
    blank = np.flatnonzero(data == 32)
    filled = np.diff(offsets) > 0
    start = np.sort(np.concatenate([offsets[:-1][filled], blank + 1]))
    end = np.sort(np.concatenate([blank, offsets[1:][filled]]))
    row = np.searchsorted(offsets, start, side="right") - 1
    token = _token_codes(data, start, end - start)
    parts, code = [], token
    for n in range(1, ngrams[1] + 1):
        if n > 1:
            # The code of n tokens from that of n - 1, where the text has another token.
            longer = np.flatnonzero(row[first] == row[np.minimum(first + n - 1, len(row) - 1)])
            longer = longer[first[longer] + n - 1 < len(row)]
            first, code = first[longer], code[longer]
            code = code * _BASE + token[first + n - 1] + np.uint64(n)
        else:
            first = np.arange(len(token))
        if n >= ngrams[0]:
            parts.append((row[first], _mix(code), start[first], end[first + n - 1]))
    return Grams(*(np.concatenate(c) for c in zip(*parts)), data)


def _token_codes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Codes of all tokens, byte after byte of those that are long enough."""
    code = np.zeros(len(start), np.uint64)
    open_, at = np.flatnonzero(size > 0), 0
    while len(open_):
        code[open_] = (code[open_] + data[start[open_] + at]) * _BASE + np.uint64(1)
        at += 1
        open_ = open_[size[open_] > at]
    return _mix(code)


def codes_of(terms: list[str]) -> np.ndarray:
    """The codes of terms."""
    tokens = pa.array(terms, pa.large_string())
    out = np.zeros(len(terms), np.uint64)
    longest = max((t.count(" ") + 1 for t in terms), default=1)
    found = grams(tokens, (1, longest))
    ends = _bytes_of(tokens)[1]
    whole = (found.start == ends[found.row]) & (found.end == ends[found.row + 1])
    out[found.row[whole]] = found.code[whole]
    return out

"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A text column arrives as one buffer of UTF-8 bytes. Word boundaries, word hashes and the
hashes of word runs are computed on the whole buffer, so there is no Python loop over words
and hardly one over texts. Hashes are polynomial in 64 bits with a final mix; equality of
words and runs below means equality of these hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20            # texts handled together; longer ones are handled alone
HASH_BYTES = 4 * PIECE_BYTES     # of a longer text that are hashed together
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _byte_table(members) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


#: Space and U+0009 to U+000D end a word; everything else belongs to one.
BLANKS = _byte_table([0x20, *range(0x09, 0x0E)])
#: Everything in ASCII but letters and digits ends a word.
NOT_ALNUM = _byte_table(b for b in range(128) if not chr(b).isalnum())
#: A-Z as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a hash over all its bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
_powers = {}


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    """``base ** 0 .. base ** n`` in 64 bits; tables are kept while they are small."""
    known = _powers.get(int(base))
    if known is None or len(known) <= n:
        known = np.full(max(n, PIECE_BYTES) + 1, base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if len(known) <= 8 * PIECE_BYTES:
            _powers[int(base)] = known
    return known


def slices(batch: pa.RecordBatch, column: str,
           limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a piece have ``limit`` bytes, or are a single text."""
    _, offsets = text_bytes(batch.column(column))
    start, n = 0, batch.num_rows
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(n, max(start + 1, stop))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and where each text starts and ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, np.int64)[column.offset:column.offset + n + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """Words of a piece. ``first[d]:first[d + 1]`` are the words of text ``d``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All runs of ``n`` words inside one text: their text, first word and hash."""
        total = len(self.hashes)
        if total < n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        doc = self.doc_of()
        inside = np.flatnonzero(doc[:total - n + 1] == doc[n - 1:])
        value = np.zeros(len(inside), np.uint64)
        for i in range(n):
            value = value * BASE + self.hashes[inside + i]
        return doc[inside], inside, mix(value)


def find_words(column: pa.Array, separators: np.ndarray = BLANKS,
               fold: np.ndarray = LOWER) -> Words:
    """Words between ``separators``, hashed after ``fold``."""
    data, offsets = text_bytes(column)
    size = len(data)
    if size == 0:
        none = np.zeros(0, np.int64)
        return Words(data, offsets, none, none, np.zeros(0, np.uint64),
                     np.zeros(len(offsets), np.int64))
    inside = np.zeros(size + 2, dtype=bool)
    inside[1:-1] = ~separators[data]
    here, before = inside[1:-1], inside[:-2].copy()
    edges = offsets[:-1][offsets[:-1] < size]
    before[edges] = False
    after = inside[2:].copy()
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(here & ~before)
    ends = np.flatnonzero(here & ~after) + 1
    first = np.searchsorted(starts, offsets)
    return Words(data, offsets, starts, ends, _hashes(data, starts, ends, fold), first)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
            fold: np.ndarray) -> np.ndarray:
    """Word hashes; bytes are turned into numbers ``HASH_BYTES`` (or one word) at a time."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        begin = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, begin + HASH_BYTES, side="right")))
        size = int(ends[stop - 1] - begin)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[fold[data[begin:begin + size]]] * powers(size)[:size],
                  out=total[1:])
        a, b = starts[at:stop] - begin, ends[at:stop] - begin
        out[at:stop] = mix((total[b] - total[a]) * powers(size, INVERSE)[a])
        at = stop
    return out


def text_hashes(column: pa.Array) -> np.ndarray:
    """Hashes of whole texts, letter case as it is."""
    data, offsets = text_bytes(column)
    return _hashes(data, offsets[:-1], offsets[1:], _SAME)


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and first word of all ``n``-word runs, in the order of the texts.

    A text with fewer words has its whole sequence as its only run; without words it has none.
    """
    parts = [words.runs(n)]
    for m in range(1, n):
        few = np.flatnonzero(words.counts == m)
        begin = words.first[few]
        whole = np.full(len(few), m, np.uint64)
        for i in range(m):
            whole = whole * BASE + words.hashes[begin + i]
        parts.append((few, begin, mix(~whole)))
    doc, start, value = (np.concatenate(x) for x in zip(*parts))
    if len(parts[0][0]) < len(doc):
        order = np.argsort(doc, kind="stable")
        doc, start, value = doc[order], start[order], value[order]
    return doc, value, start


def distinct_sorted(doc: np.ndarray, values: np.ndarray,
                    n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``values`` of each of ``n`` texts in ascending order, text by text."""
    values = values.copy()
    edges = np.searchsorted(doc, np.arange(n + 1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        values[a:b].sort()
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
    return doc[new], values[new]

"""Static range asymmetric numeral system over token ids, in self-contained segments.

A segment holds many documents: one frequency table shared by its blocks, an index of blocks,
and the blocks. A block holds whole documents and is coded on its own by ``LANES`` interleaved
coders, token ``t`` by coder ``t % LANES``, so all coders advance together in array operations.
Its index entry tells its documents, tokens, bytes and CRC-32; checkpoints inside it (positions
in the coded words with the coders' states) let decoders start in its middle.

Layout, all numbers little-endian::

    magic "RANS1\\0", u16 scale bits, u32 symbols, u32 blocks, u32 documents
    symbols x (u32 token id, u32 frequency)        frequencies sum up to 1 << scale bits
    documents x u32 tokens
    blocks x (u32 documents, u32 tokens, u32 bytes, u32 CRC-32 of the block's bytes)
    blocks: u32 checkpoints, each (u32 step, u32 word, LANES x u64 states); u32 words
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

MAGIC = b"RANS1\0"
LANES = 1024
BLOCK_TOKENS = 1 << 18         # a block is closed by the document that reaches this
CHECKPOINT_STEPS = 128
MIN_SCALE = 16
_LOW = np.uint64(1 << 31)      # states stay in [2 ** 31, 2 ** 63)
_HEADER = struct.Struct("<6sHIII")


def frequency_table(counts: np.ndarray, scale: int) -> np.ndarray:
    """Positive frequencies in proportion to ``counts`` that sum up to ``1 << scale``."""
    total, goal = int(counts.sum()), 1 << scale
    out = np.maximum(1, counts.astype(np.int64) * goal // total)
    rest = goal - int(out.sum())
    if rest >= 0:
        out[np.argmax(out)] += rest
        return out
    for i in np.argsort(-out, kind="stable"):       # take back what the ones added
        take = min(-rest, int(out[i]) - 1)
        out[i] -= take
        rest += take
        if rest == 0:
            return out
    raise ValueError("more symbols than the scale has room for")


def encode_block(index: np.ndarray, freq: np.ndarray, scale: int) -> bytes:
    """Code symbol numbers; the last symbols go first, so that decoding runs forwards."""
    freq = freq.astype(np.uint64)
    start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    bits, shift = np.uint64(scale), np.uint64(63 - scale)
    states = np.full(LANES, _LOW)
    steps = -(-len(index) // LANES)
    words, emitted, checkpoints = [], 0, []
    for step in range(steps - 1, -1, -1):
        symbols = index[step * LANES:(step + 1) * LANES]
        n = len(symbols)
        x, f = states[:n], freq[symbols]
        full = x >= f << shift
        out = x[full]
        if len(out):
            words.append((out & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            emitted += len(out)
            x[full] = out >> np.uint64(32)
        high = x // f
        states[:n] = (high << bits) + (x - high * f) + start[symbols]
        if step % CHECKPOINT_STEPS == 0:
            checkpoints.append((step, emitted, states.copy()))
    if not steps:
        checkpoints.append((0, 0, states))
    parts = [struct.pack("<I", len(checkpoints))]
    for step, before, at in reversed(checkpoints):
        parts += [struct.pack("<II", step, emitted - before), at.astype("<u8").tobytes()]
    return b"".join(parts + [w.astype("<u4").tobytes() for w in reversed(words)])


def decode_block(data: bytes, tokens: int, freq: np.ndarray, slots: np.ndarray, scale: int,
                 checkpoint: int = 0) -> np.ndarray:
    """Symbol numbers from ``checkpoint`` on; ``slots`` has the symbol of each slot."""
    (count,) = struct.unpack_from("<I", data)
    size = 8 + 8 * LANES
    first, word = struct.unpack_from("<II", data, 4 + checkpoint * size)
    states = np.frombuffer(data, "<u8", LANES, 12 + checkpoint * size).astype(np.uint64)
    words = np.frombuffer(data, "<u4", offset=4 + count * size).astype(np.uint64)
    freq = freq.astype(np.uint64)
    start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    mask, bits = np.uint64((1 << scale) - 1), np.uint64(scale)
    out = np.empty(max(0, tokens - first * LANES), np.int64)
    for at in range(0, len(out), LANES):
        n = min(LANES, len(out) - at)
        x = states[:n]
        slot = x & mask
        symbols = slots[slot]
        out[at:at + n] = symbols
        x = freq[symbols] * (x >> bits) + slot - start[symbols]
        low = x < _LOW
        more = int(np.count_nonzero(low))
        if more:
            x[low] = (x[low] << np.uint64(32)) | words[word:word + more]
            word += more
        states[:n] = x
    return out


def encode_segment(tokens: np.ndarray, lengths: np.ndarray,
                   block_tokens: int = BLOCK_TOKENS) -> bytes:
    """A segment of documents whose token ids stand one after the other in ``tokens``."""
    lengths = np.asarray(lengths, np.int64)
    counts = np.bincount(tokens)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    number = np.zeros(int(symbols[-1]) + 1 if len(symbols) else 0, np.int64)
    number[symbols] = np.arange(len(symbols))
    index = number[tokens]
    scale = max(MIN_SCALE, len(symbols).bit_length() + 2)
    freq = frequency_table(counts, scale) if len(symbols) else np.zeros(0, np.int64)
    ends, blocks, begin, first = np.cumsum(lengths), [], 0, 0
    while first < len(lengths):
        last = min(int(np.searchsorted(ends, begin + block_tokens)), len(lengths) - 1)
        end = int(ends[last])
        data = encode_block(index[begin:end], freq, scale)
        blocks.append((last + 1 - first, end - begin, data))
        begin, first = end, last + 1
    head = _HEADER.pack(MAGIC, scale, len(symbols), len(blocks), len(lengths))
    table = np.column_stack([symbols, freq]).astype("<u4").tobytes()
    entries = [struct.pack("<IIII", n, t, len(data), zlib.crc32(data)) for n, t, data in blocks]
    return b"".join([head, table, lengths.astype("<u4").tobytes(), *entries,
                     *(data for _, _, data in blocks)])


@dataclass
class Segment:
    """A segment read back; blocks are decoded on demand."""

    symbols: np.ndarray
    freq: np.ndarray
    scale: int
    lengths: np.ndarray
    entries: np.ndarray
    data: bytes
    offset: int

    @classmethod
    def open(cls, data: bytes) -> "Segment":
        magic, scale, n_symbols, n_blocks, n_docs = _HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = _HEADER.size
        table = np.frombuffer(data, "<u4", 2 * n_symbols, at).reshape(-1, 2)
        at += 8 * n_symbols
        lengths = np.frombuffer(data, "<u4", n_docs, at)
        at += 4 * n_docs
        entries = np.frombuffer(data, "<u4", 4 * n_blocks, at).reshape(-1, 4).astype(np.int64)
        return cls(table[:, 0], table[:, 1], scale, lengths.astype(np.int64), entries, data,
                   at + 16 * n_blocks)

    def block(self, number: int) -> np.ndarray:
        """Token ids of one block."""
        begin = self.offset + int(self.entries[:number, 2].sum())
        _, tokens, size, crc = (int(x) for x in self.entries[number])
        data = self.data[begin:begin + size]
        if zlib.crc32(data) != crc:
            raise ValueError(f"block {number} is damaged")
        return self.symbols[decode_block(data, tokens, self.freq, self.slots(), self.scale)]

    def slots(self) -> np.ndarray:
        if not hasattr(self, "_slots"):
            self._slots = np.repeat(np.arange(len(self.freq)), self.freq)
        return self._slots

    def documents(self) -> list[np.ndarray]:
        """Token ids of every document."""
        tokens = [self.block(i) for i in range(len(self.entries))]
        tokens = np.concatenate([np.zeros(0, np.uint32), *tokens])
        return np.split(tokens, np.cumsum(self.lengths)[:-1]) if len(self.lengths) else []

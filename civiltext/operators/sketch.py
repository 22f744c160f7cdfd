"""A counting filter: which keys surely occur in too few rows, before anything is shuffled.

Each task counts, in a table of fixed size, the rows that hold a key of each cell; a row counts
once per cell, and counts stop at the limit. The tables of all tasks, cut into slices, are added
up; cells below the limit hold no key that reaches it. Keys that share a cell with others may
pass although they are rare, so what passes has to be counted exactly; what does not pass is rare
for certain. With far more keys than cells the filter lets everything through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CELLS = 1 << 24
SLICES = 256


def cells_of(keys: np.ndarray, cells: int) -> np.ndarray:
    """The cells of 64-bit keys; ``cells`` is a power of two."""
    return (keys & np.uint64(cells - 1)).astype(np.int64)


def count_rows(batches: Iterable[tuple[np.ndarray, np.ndarray]], least: int,
               cells: int = CELLS) -> Iterator[pa.RecordBatch]:
    """What a task counts of its batches ``(row, key)``, to be added up by ``reached``."""
    if cells < 8 * SLICES or cells & (cells - 1):
        raise ValueError(f"{cells} is no power of two from {8 * SLICES} on")
    counts = np.zeros(cells, np.min_scalar_type(least))
    for row, keys in batches:
        once = np.unique(row * cells + cells_of(keys, cells)) & (cells - 1)
        cell, n = np.unique(once, return_counts=True)
        counts[cell] = np.minimum(counts[cell] + n, least)
    parts = [(i, _packed(part, least)) for i, part in enumerate(np.split(counts, SLICES))
             if part.any()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())],
        names=["slice", "counts"])


COUNTED = "slice int, counts binary"


def _packed(counts: np.ndarray, least: int) -> bytes:
    """Counts as planes of bits, which are nearly empty and so compress well."""
    planes = [np.packbits(counts >> bit & 1) for bit in range(least.bit_length())]
    return zlib.compress(np.concatenate(planes))


def _unpacked(packed: bytes, least: int) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(least.bit_length(), -1)
    return sum(np.unpackbits(plane).astype(np.int64) << bit for bit, plane in enumerate(planes))


def _added_up(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """One bit per cell of each slice: whether it reached the limit in all tasks together."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for number, own in groupby(rows, key=lambda row: row[0]):
        total = 0
        for _, counts in own:
            total = np.minimum(_unpacked(counts, least) + total, least)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()),
             pa.array([np.packbits(total >= least).tobytes()], pa.binary())],
            names=["slice", "reached"])


def reached(counted: DataFrame, least: int, cells: int = CELLS) -> np.ndarray:
    """A bit per cell, packed: whether ``least`` rows or more hold a key of it."""
    added = counted.repartition("slice").sortWithinPartitions("slice").mapInArrow(
        lambda batches: _added_up(batches, least), "slice int, reached binary")
    bits = np.zeros((SLICES, cells // SLICES // 8), np.uint8)
    for number, part in added.collect():  # as many bytes in all as a bit per cell takes
        bits[number] = np.frombuffer(part, np.uint8)
    return bits.ravel()


def may_reach(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may occur in enough rows."""
    cell = cells_of(keys, 8 * len(bits))
    return (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)

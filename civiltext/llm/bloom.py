"""A Bloom filter over 64-bit keys of a distributed table, of a fixed size.

The filter has ``1 << bits`` bits whatever the table holds, so it may be sent to every
executor. It only saves work: what it lets through is joined exactly. When a table outgrows
it, more is let through and nothing is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from civiltext.llm.words import mix

BITS = 23


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    keys = mix(keys.view(np.uint64) if keys.dtype == np.int64 else keys)
    low = (keys & np.uint64((1 << bits) - 1)).astype(np.int64)
    high = (keys >> np.uint64(64 - bits)).astype(np.int64)
    return low, high


class Bloom:
    def __init__(self, table: np.ndarray, bits: int):
        self.table, self.bits = table, bits

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be in the table; never wrong about one that is."""
        low, high = _places(keys, self.bits)
        one = np.uint8(1)
        return (((self.table[low >> 3] >> (low & 7).astype(np.uint8)) & one)
                & ((self.table[high >> 3] >> (high & 7).astype(np.uint8)) & one)).astype(bool)


def build(df: DataFrame, key: str, bits: int = BITS) -> Bloom:
    """Fill a filter from the ``long`` column ``key``.

    At most ``1 << (bits - 6)`` rows come to the driver: the words of the bit table.
    """
    def places(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            both = np.unique(np.concatenate(_places(keys, bits)))
            yield pa.RecordBatch.from_arrays(
                [pa.array((both >> 6).astype(np.int32)),
                 pa.array(np.left_shift(np.uint64(1), (both & 63).astype(np.uint64))
                          .view(np.int64))],
                names=["word", "mask"])

    words = (df.select(F.col(key).cast("long").alias("key")).filter("key IS NOT NULL")
             .mapInArrow(places, "word int, mask long")
             .groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow())
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[words.column("word").to_numpy()] = words.column("mask").to_numpy().view(np.uint64)
    return Bloom(table.view(np.uint8), bits)

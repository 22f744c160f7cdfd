"""Broadcast only what was counted and found small; otherwise salt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20


def is_small(table: DataFrame, text_cols: list[str], max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether ``table`` is within both limits, by counting at most ``max_rows + 1`` rows."""
    head = table.limit(max_rows + 1)
    size = F.lit(0)
    for name in text_cols:
        size = size + F.coalesce(F.octet_length(name), F.lit(0))
    rows, octets = head.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and octets <= MAX_BROADCAST_BYTES


def lookup_join(big: DataFrame, table: DataFrame, key: str, spread: Column,
                how: str = "inner", max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join ``big`` to a lookup ``table`` on ``key``.

    A table of checked size is broadcast. A larger one is joined by shuffle, with a salt
    taken from ``spread`` (any column that varies within a key), because word frequencies
    are so uneven that a single word can make up a third of all rows. As many salts are used
    as bring the most frequent key down to an even share of a partition.
    """
    text_cols = [n for n, t in table.dtypes if t == "string"]
    if is_small(table, text_cols, max_rows):
        return big.join(F.broadcast(table), key, how)
    most, rows = (big.groupBy(key).agg(F.count("*").alias("n"))
                  .agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first())
    parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, -(-most * parts // max(1, rows)))
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")

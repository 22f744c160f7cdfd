"""Reading files of quoted records, which may hold line breaks, in many tasks.

A line break ends a record only where the number of quotes before it is even, so a task that
starts inside a file does not know what its first line is part of. A first pass counts the quotes
of every byte range; their sums over the ranges before tell whether a range starts inside quotes.
Each range is then cut into records by its own task, and only the pieces of records that cross
from one range into the next, two per range at most, are shuffled and put together.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

WHOLE, OPEN, INNER, LAST = 0, 1, 2, 3   # a record; the start, middle and end of one
_PIECES = "file string, range long, number long, kind int, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, range, line``: the lines of all files, those of a byte range in their order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"), F.col("value").alias("line"))


class _Quotes:
    """Whether a byte range starts inside quotes: a few bytes for each range of a file."""

    def __init__(self, counts: list[tuple[str, int, int]]):
        by_file = defaultdict(list)
        for file, start, odd in counts:
            by_file[file].append((start, odd))
        self.starts, self.inside = {}, {}
        for file, ranges in by_file.items():
            starts, odd = np.array(sorted(ranges), np.int64).T
            self.starts[file] = starts
            self.inside[file] = ((np.cumsum(odd) - odd) % 2).astype(bool)

    def at(self, file: str, start: int) -> bool:
        return bool(self.inside[file][np.searchsorted(self.starts[file], start)])


def _cut(batches: Iterator[pa.RecordBatch], quotes: _Quotes) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    here, number, held, inside, begun = None, 0, [], False, True

    def close(kind: int) -> None:
        nonlocal number, held
        rows.append((*here, number, kind, "\n".join(held)))
        number, held = number + 1, []

    def batch() -> pa.RecordBatch:
        nonlocal rows
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        columns = list(zip(*rows)) or [()] * len(kinds)
        rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=["file", "range", "number", "kind", "text"])

    for lines in batches:
        for file, start, line in zip(*(c.to_pylist() for c in lines.columns)):
            if (file, start) != here:
                if held:
                    close(OPEN if begun else INNER)
                here, number = (file, start), 0
                inside = quotes.at(file, start)
                begun = not inside       # whether the record held starts in this range
            held.append(line)
            inside ^= line.count('"') % 2 == 1
            if not inside:
                close(WHOLE if begun else LAST)
                begun = True
        yield batch()
    if held:
        close(OPEN if begun else INNER)
    yield batch()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, range, number, text``: the records of all files, line breaks within quotes kept.

    ``range`` and ``number`` give their order in a file. Empty lines between records are none. A
    record whose quotes never close reaches to the end of its file.
    """
    lines = _lines(spark, path)
    odd = F.sum(F.length("line") - F.length(F.replace("line", F.lit('"')))) % 2
    quotes = spark.sparkContext.broadcast(_Quotes(
        [tuple(r) for r in lines.groupBy("file", "range").agg(odd).collect()]))
    pieces = lines.mapInArrow(lambda batches: _cut(batches, quotes.value), _PIECES)
    whole = pieces.filter(F.col("kind") == WHOLE)
    order = Window.partitionBy("file").orderBy("range", "number")
    parts = pieces.filter(F.col("kind") != WHOLE) \
                  .withColumn("record", F.sum((F.col("kind") == OPEN).cast("int")).over(order))
    joined = parts.groupBy("file", "record").agg(
        F.min(F.struct("range", "number")).alias("first"),
        F.array_sort(F.collect_list(F.struct("range", "number", "text"))).alias("parts"))
    joined = joined.select("file", "first.range", "first.number", F.array_join(
        F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
    text = F.replace(F.regexp_replace("text", "\r$", ""), F.lit("\r\n"), F.lit("\n"))
    return whole.select("file", "range", "number", "text").unionByName(joined) \
        .withColumn("text", text).filter("text <> ''")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with a header each, all columns as strings; doubled quotes stand for one."""
    options = {"quote": '"', "escape": '"', "multiLine": "true", "header": "true"}
    header = spark.read.options(**options).csv(path).columns
    records = read_records(spark, path)
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in header)
    del options["header"]
    parsed = records.filter("range > 0 OR number > 0").select(
        F.from_csv("text", schema, {**options, "mode": "PERMISSIVE"}).alias("r"))
    return parsed.select(*[F.col("r").getField(c).alias(c) for c in header])

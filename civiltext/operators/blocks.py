"""Tables too large for the tasks, looked up by blocks of texts.

Texts are dealt into blocks of bounded size. A block lists its words once, however many of its
texts have them, and gets the rows of the large table they lead to. The texts then stand behind
these rows in one partition, so a task holds what a single block looks up and nothing else; no row
is made per text and word.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLOCK_BYTES = 32 << 20      # of texts in a block, about
HELD_BYTES = 32 << 20       # of words that a task lists before it hands them on
ROWS = 500                  # looked up at once
BLOCK, ITEM = "_block", "_item"


def with_blocks(df: DataFrame, text_col: str) -> tuple[DataFrame, int]:
    """``df`` with the number of each row's block, and how many blocks there are.

    The number comes from the whole row, so copies of a text that differ in anything else are
    spread, and reading the rows again gives the same numbers.
    """
    octets = df.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    blocks = max(df.sparkSession.sparkContext.defaultParallelism, -(-octets // BLOCK_BYTES))
    told = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]
    return df.withColumn(BLOCK, F.pmod(F.xxhash64(*told), F.lit(blocks)).cast("int")), blocks


def block_words(df: DataFrame, columns: list[str], words: Callable[..., set[str]]) -> DataFrame:
    """``_block, first``, distinct: what ``words`` finds in ``columns`` of the rows of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def listed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, own in held.items() for _ in own], pa.int32()),
                 pa.array([w for own in held.values() for w in own], pa.string())],
                names=[BLOCK, "first"])

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for block, *texts in zip(*(c.to_pylist() for c in part.columns)):
                    own = held.setdefault(block, set())
                    new = words(*texts) - own
                    own |= new
                    size += sum(map(len, new)) + 100 * len(new)
                if size > HELD_BYTES:
                    yield listed()
                    held, size = {}, 0
        yield listed()

    return df.select(BLOCK, *columns).mapInArrow(run, f"{BLOCK} int, first string").distinct()


def beside(df: DataFrame, items: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``df`` with ``_item``, which is null; each block's stand in one partition, behind
    its rows of ``items``, which have ``_item`` alone."""
    kept = [F.col(c) for c in items.columns if c != BLOCK]
    rows = items.select(BLOCK, F.struct(*kept).alias(ITEM))
    texts = df.withColumn(ITEM, F.lit(None).cast(rows.schema[ITEM].dataType))
    rows = rows.select(*[F.col(c) if c == BLOCK else F.lit(None).cast(df.schema[c].dataType).alias(c)
                         for c in df.columns], ITEM)
    return texts.unionByName(rows).repartitionById(blocks, F.col(BLOCK)) \
                .sortWithinPartitions(BLOCK, F.col(ITEM).isNull())


def looked_up(batches: Iterator, make: Callable[[list[dict]], Callable]) -> Iterator[list]:
    """For batches of ``_block, _item`` and other columns, in the order of ``beside``: what the
    function that ``make`` makes of a block's items says of the others; None for the items."""
    block, items, work = None, [], None
    for numbers, listed, *others in batches:
        found = []
        for number, item, *values in zip(numbers.to_pylist(), listed.to_pylist(),
                                         *(c.to_pylist() for c in others)):
            if number != block:
                block, items, work = number, [], None
            if item is not None:
                items.append(item)
                found.append(None)
                continue
            if work is None:
                work, items = make(items), []
            found.append(work(*values))
        yield found


def looked_up_arrays(batches: Iterator, make: Callable[[list[dict]], Callable],
                     build: Callable[[list], pa.Array]) -> Iterator[pa.Array]:
    """An array per batch: what ``build`` makes of what ``looked_up`` says, ``ROWS`` rows at a time,
    so that no whole batch and its outcome become Python objects."""
    counts, parts = deque(), []

    def slices() -> Iterator:
        for columns in batches:
            starts = range(0, max(1, len(columns[0])), ROWS)
            counts.append(len(starts))
            yield from (tuple(c.slice(at, ROWS) for c in columns) for at in starts)

    for found in looked_up(slices(), make):
        parts.append(build(found))
        if len(parts) == counts[0]:
            yield pa.concat_arrays(parts)
            counts.popleft()
            parts = []

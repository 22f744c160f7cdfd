"""Groups of spelling variants: words one edit apart, found by dynamic programming in sorted lists.

Words are maximal runs of Latin letters, A-Z lower-cased. Two words are near if exactly one code
point inserted, deleted or replaced turns one into the other. A word's form is its near word of
largest count (ties: the first in code-point order) if that is ``ratio`` times its own count or
more; following forms leads to its root.

The distinct words, sorted, are cut into blocks of even size, once as they are and once reversed.
One edit leaves the first half of a word as it is or the second, so a word's near words stand
where its first half leads in one list or its second half in the other. In a block, rows of the
edit matrix (three cells around the diagonal) are computed along an entry and kept for the code
points that the next entry shares with it; once a row has no cell under two, all entries that
share what was read so far are skipped. Each block gives one row per word that looked into it:
how many near words it has and the best of them, never the pairs.

Missing texts have no words, as have empty ones; a missing id counts as an empty one. Repeated
rows count as often as they occur. No words give an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import groupby, pairwise
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from civiltext.sources.shared import cut_lineage

RUN = re.compile(r"[a-zÀ-ÿ]+")
SEAM = re.compile(r"[^A-Za-zÀ-ÿ]")
STRETCH = 1 << 20               # code points of a text handled at once, or up to the end of a word
HELD_BYTES = 32 << 20           # of words that a task counts before it hands them on
BLOCK_WORDS = 1000
MAX_BLOCKS = 16_384
SAMPLES_PER_BLOCK = 8
BOUNDARY_LENGTH = 256
_LAST = chr(0x10FFFF)


def _stretches(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > STRETCH and (seam := SEAM.search(text, start + STRETCH)):
        yield text[start:seam.start()]
        start = seam.start()
    yield text[start:]


def text_words(text: str, doc_id, min_length: int, damage: int | None) -> Counter:
    """How often each word of ``min_length`` code points or more occurs in a text.

    With ``damage``, a run loses a code point if ``damage`` divides the CRC-32 of
    ``<doc_id>:<run>``: the one whose number is the rest of that CRC-32 by the run's length.
    """
    counts = Counter()
    for stretch in _stretches(text):
        # Lower-casing bytes concerns A-Z only.
        counts.update(RUN.findall(stretch.encode().lower().decode()))
    counts = Counter({run: n for run, n in counts.items() if len(run) >= min_length})
    if damage:
        start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
        # Apart from the runs still to come: one may lose a code point to what another became.
        damaged = Counter()
        for run, n in counts.items():
            crc = zlib.crc32(run.encode(), start)
            if crc % damage == 0:
                at = crc % len(run)
                run = run[:at] + run[at + 1:]
            damaged[run] += n
        return damaged
    return counts


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_length: int = 6, min_count: int = 5, damage: int | None = None) -> DataFrame:
    """``word, n`` of the words with ``min_length`` code points and ``min_count`` occurrences.

    Tasks count what they read before anything is shuffled, so a frequent word is no hot key.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
               .filter("text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = Counter(), 0

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(),
                                    batch.column("text").to_pylist()):
                for word, n in text_words(text, doc_id, min_length, damage).items():
                    if len(word) >= min_length:
                        if word not in held:
                            size += 150 + len(word)
                        held[word] += n
                if size > HELD_BYTES:
                    yield counted()
                    held, size = Counter(), 0
        yield counted()

    return docs.mapInArrow(run, "word string, n long").groupBy("word") \
               .agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class SortedList:
    """Ascending distinct words, and how many code points each shares with the one before."""

    def __init__(self, entries: list[str]):
        self.entries = entries
        self.shared = [0, *(len(commonprefix(pair)) for pair in pairwise(entries))]

    def near(self, word: str, kept: int) -> Iterator[int]:
        """Places of the entries that start as ``word`` does for ``kept`` code points and are
        exactly one edit away from it."""
        entries, shared = self.entries, self.shared
        size, prefix, query = len(word), word[:kept], word + "\0\0"
        at, stop = bisect_left(entries, prefix), bisect_right(entries, prefix + _LAST)
        # rows[d]: edits between the entry's first d code points and the first d - 1, d and
        # d + 1 of the word; known for those that the entry shares with the one before.
        rows = [(2, 2, 2)] * kept + [(1 if kept else 2, 0, 1)]
        valid = kept
        while at < stop:
            entry = entries[at]
            length, dead = len(entry), False
            del rows[valid + 1:]
            if -2 < size - length < 2:
                left, same, right = rows[valid]
                for depth in range(valid, length):
                    c = entry[depth]
                    left = min(left + (c != query[depth - 1]), same + 1)
                    same = min(same + (c != query[depth]), right + 1, left + 1)
                    right = min(right + (c != query[depth + 1]), same + 1)
                    if left > 1 and same > 1 and right > 1:
                        dead = True
                        break
                    rows.append((left, same, right))
                if not dead and rows[length][size - length + 1] == 1:
                    yield at
            if dead:
                at = bisect_right(entries, entry[:depth + 1] + _LAST, at + 1, stop)
            else:
                at += 1
            if at < stop:
                valid = max(kept, min(len(rows) - 1, shared[at]))


def may_hold(word: str, first: str, stop: str) -> bool:
    """Whether a text from ``first`` on and before ``stop`` may be within one edit of ``word``.

    What all texts between have in common either uses up the edit, which leaves three texts to
    look for, or agrees with the word; then only texts at the two ends need a closer look.
    """
    shared = commonprefix((first, stop))
    size, same = len(shared), len(commonprefix((word, shared)))
    after, rest = shared[same:], word[same:]
    if not after:
        low, high = first[size:size + 1], stop[size]
        own = word[size:size + 1]
        if low <= own <= high or (low < high and (not low or ord(high) - ord(low) > 1)):
            return True
        ends = [shared + word[size + 1:], shared + low + word[size + 1:], shared + low + word[size:],
                shared + high + word[size + 1:], shared + high + word[size:]]
    else:
        ends = [shared + word[len(shared) + shift:] for shift, fits in (
            (0, rest[1:].startswith(after[1:])), (1, rest[1:].startswith(after)),
            (-1, rest.startswith(after[1:]))) if fits]
    return any(first <= text < stop for text in ends)


class Blocks:
    """Where a sorted list is cut; ``bounds[i]`` is the first text of block ``i + 1``."""

    def __init__(self, bounds: list[str]):
        self.bounds = bounds
        self.ends = [*pairwise(["", *bounds, _LAST])]

    def of(self, text: str) -> int:
        return bisect_right(self.bounds, text)

    def to_search(self, word: str, kept: int) -> Iterator[int]:
        """Blocks that may hold near words which share the first ``kept`` code points."""
        prefix = word[:kept]
        for block in range(self.of(prefix), self.of(prefix + _LAST) + 1):
            if may_hold(word, *self.ends[block]):
                yield block


def _halves(word: str) -> Iterator[tuple[str, int]]:
    """The word and its first half, the reversed word and its second half."""
    half = len(word) // 2
    yield word, half
    yield word[::-1], len(word) - half


def _cut(words: DataFrame, n: int, block_words: int) -> list[Blocks]:
    """Blocks of both lists, from a sample of words whose size is bounded."""
    blocks = min(MAX_BLOCKS, -(-n // block_words))
    share = math.ceil(SAMPLES_PER_BLOCK * blocks / max(n, 1) * 2**30)
    sample = words.filter(F.pmod(F.xxhash64("word"), F.lit(2**30)) < share)
    found = [sorted({r[0] for r in sample.select(F.left(text, F.lit(BOUNDARY_LENGTH))).collect()})
             for text in (F.col("word"), F.reverse("word"))]
    # Fewer texts than blocks make fewer blocks.
    return [Blocks(sorted({texts[i * len(texts) // blocks] for i in range(1, blocks)}) if texts else [])
            for texts in found]


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, n, n_near, best, best_n``: near words of each word in ``word, n``, and the one of
    largest ``n`` (ties: the first). Words must be distinct."""
    spark = words.sparkSession
    cuts = spark.sparkContext.broadcast(_cut(words, words.count(), block_words))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                for side, (text, kept) in enumerate(_halves(word)):
                    blocks = cuts.value[side]
                    rows.append((2 * blocks.of(text) + side, False, text, n))
                    rows += [(2 * b + side, True, text, n) for b in blocks.to_search(text, kept)]
            block, asks, text, n = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int32()), pa.array(asks, pa.bool_()),
                 pa.array(text, pa.string()), pa.array(n, pa.int64())],
                names=["block", "asks", "text", "n"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((batch, *row) for batch in batches
                for row in zip(*(batch.column(c).to_pylist() for c in range(4))))
        for block, own in groupby(rows, key=lambda row: row[1]):
            reversed_ = bool(block % 2)
            entries, counts, found, known = [], [], [], None
            for _, _, asks, text, n in own:
                if not asks:
                    entries.append(text)
                    counts.append(n)
                    continue
                known = known or SortedList(entries)
                found.append(_ask(known, counts, text, n, reversed_))
                if len(found) == 10_000:
                    yield _answers(found)
                    found = []
            yield _answers(found)

    dealt = words.select("word", "n").mapInArrow(
        deal, "block int, asks boolean, text string, n long")
    # A number given keeps Spark from putting many blocks into one task: rows are short, searches long.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                spark.sparkContext.defaultParallelism)
    answers = dealt.repartition(tasks, "block").sortWithinPartitions("block", "asks", "text").mapInArrow(
        search, "word string, n long, n_near long, best string, best_n long")
    best = F.min(F.when(F.col("best_n").isNotNull(),
                        F.struct((-F.col("best_n")).alias("less"), F.col("best"))))
    return answers.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b")) \
        .select("word", "n", "n_near", F.col("b.best").alias("best"),
                (-F.col("b.less")).alias("best_n"))


def _ask(known: SortedList, counts: list[int], text: str, n: int, reversed_: bool) -> tuple:
    word = text[::-1] if reversed_ else text
    half = len(word) // 2
    kept = len(word) - half if reversed_ else half
    near, best, best_n = 0, None, None
    for at in known.near(text, kept):
        other = known.entries[at]
        if reversed_:
            other = other[::-1]
            if other.startswith(word[:half]):
                continue        # the other list has it
        near += 1
        if best is None or (-counts[at], other) < (-best_n, best):
            best, best_n = other, counts[at]
    return word, n, near, best, best_n


def _answers(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * 5
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=["word", "n", "n_near", "best", "best_n"])


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: where following forms from a word ends.

    Counts grow along forms, so there are no circles; the steps taken double in every round.
    """
    now = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut_lineage(now.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")))
        now = moved.select("word", "root")
        if moved.filter("on").isEmpty():
            return now


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_length: int = 6, min_count: int = 5, ratio: int = 5,
                   damage: int | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words of all texts."""
    words = cut_lineage(count_words(docs, id_col, text_col, min_length, min_count, damage))
    enough = F.col("best_n") >= ratio * F.col("n")
    near = cut_lineage(near_words(words, block_words).select(
        "word", "n", "n_near", F.when(enough, F.col("best")).alias("form"),
        F.when(enough, F.col("best_n")).alias("form_n")))
    ends = roots(near.filter("form IS NOT NULL"))
    return near.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

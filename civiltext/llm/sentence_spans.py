"""Substring deduplication by sliding runs of sentences.

A sentence ends with a word that ends in ``.``, ``!``, ``?`` or another script's mark (a closing
quote or bracket may follow), at a line break or at the end of the text. Runs of consecutive sentences slide over
every text: from each sentence the shortest run of at least ``min_sentences`` sentences and
``min_words`` words that starts there, and the shortest that ends there, so that a repeated
passage is covered to both its ends. A sentence of ``LONG_SENTENCE`` words is a run by itself,
and so is a text that is one sentence of ``min_words`` words. Runs are hashed over their lower-cased words and joined
over the whole corpus. The first occurrence of a run is the one with the smallest id (missing
ids first), then by text hash and position; sentences covered by any other occurrence go.

Texts too short for a run are left alone. Rows equal in id and text count as one document and
get the same result; a missing text is an empty one. Rows of one id are told apart by 64 bits of
a hash of their texts, rows without an id by 128. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from civiltext.llm import bloom
from civiltext.llm.words import BASE, INVERSE, Words, find_words, mix, powers, slices
from civiltext.sources.shared import cut_lineage

MIN_SENTENCES = 2
MIN_WORDS = 12
LONG_SENTENCE = 50             # words
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?")] = True
_CLOSES = np.zeros(256, dtype=bool)
_CLOSES[list(b"\"')]}")] = True
# Sentence marks and closing quotes and brackets outside ASCII.
_MARKS = [np.frombuffer(c.encode(), np.uint8) for c in "。．！？｡…।॥۔؟։።។။།"]
_CLOSERS = [np.frombuffer(c.encode(), np.uint8) for c in "”’»」』）】"]
_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[0x0A, 0x0B, 0x0C, 0x0D]] = True


def _ends_in(words: Words, at: np.ndarray, end: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Whether the first bytes, up to ``end``, of the words ``at`` end in ``sign``."""
    hit = end - words.starts[at] >= len(sign)
    for k, byte in enumerate(sign):
        hit &= words.data[np.maximum(end - len(sign) + k, 0)] == byte
    return hit


def _marked(words: Words, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the first bytes, up to ``end``, of the words ``at`` end in a sentence mark."""
    last = words.data[np.maximum(end - 1, 0)]
    hit = _ENDS[last] & (end > words.starts[at])
    other = np.flatnonzero(last >= 0x80)
    for mark in _MARKS if len(other) else ():
        hit[other] |= _ends_in(words, at[other], end[other], mark)
    return hit


def sentences(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First words of all sentences (with the number of words at the end), and the number of
    the first sentence of each text (with the number of sentences at the end)."""
    total = len(words.starts)
    if total == 0:
        return np.zeros(1, np.int64), np.zeros(len(words.first), np.int64)
    every, last = np.arange(total), words.data[words.ends - 1]
    closes = _marked(words, every, words.ends)
    at = np.flatnonzero(_CLOSES[last])
    closes[at] |= _marked(words, at, words.ends[at] - 1)
    other = np.flatnonzero(last >= 0x80)
    for sign in _CLOSERS if len(other) else ():
        at = other[_ends_in(words, other, words.ends[other], sign)]
        closes[at] |= _marked(words, at, words.ends[at] - len(sign))
    breaks = np.flatnonzero(_BREAKS[words.data])
    closes[:-1] |= np.searchsorted(breaks, words.starts[1:]) > np.searchsorted(breaks, words.ends[:-1])
    stops = words.first[1:] - 1
    closes[stops[words.counts > 0]] = True
    begins = np.concatenate([[0], np.flatnonzero(closes) + 1])
    return begins, np.searchsorted(begins, words.first)


def runs(words: Words, min_sentences: int,
         min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first sentence in the text, number of sentences and hash of every run."""
    begins, first = sentences(words)
    count = len(begins) - 1
    each = np.arange(count)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    stop = np.maximum(each + min_sentences, np.searchsorted(begins, begins[:-1] + min_words))
    good = stop <= first[doc + 1] if count else np.zeros(0, bool)
    ahead = each[good], stop[good]
    start = np.minimum(each + 1 - min_sentences,
                       np.searchsorted(begins, begins[1:] - min_words, side="right") - 1)
    good = start >= first[doc] if count else np.zeros(0, bool)
    back = start[good], each[good] + 1
    begin, end = np.concatenate([ahead[0], back[0]]), np.concatenate([ahead[1], back[1]])
    order = np.lexsort((end, begin))
    begin, end = begin[order], end[order]
    new = np.ones(len(begin), bool)
    new[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    begin, end = begin[new], end[new]
    # Where runs have several sentences, long ones and whole texts are runs by themselves.
    long = np.diff(begins)
    alone = (long >= LONG_SENTENCE) | ((np.diff(first)[doc] == 1) & (long >= min_words))
    alone = np.flatnonzero(alone) if min_sentences > 1 else np.zeros(0, np.int64)
    begin, end = np.concatenate([begin, alone]), np.concatenate([end, alone + 1])
    up = powers(len(words.hashes))
    sums = np.zeros(len(words.hashes) + 1, np.uint64)
    np.cumsum(words.hashes * up[:len(words.hashes)], out=sums[1:])
    a, b = begins[begin], begins[end]
    value = mix((sums[b] - sums[a]) * powers(len(words.hashes), INVERSE)[a]
                + (b - a).astype(np.uint64) * BASE)
    return doc[begin], begin - first[doc[begin]], end - begin, value


def _keys() -> dict[str, Column]:
    """What tells rows apart beside their ids."""
    more = F.xxhash64("text", F.lit("more"))
    return {"key": F.xxhash64("text"),
            "more": F.when(F.col("id").isNull(), more).otherwise(F.lit(0))}


def _runs_of(docs: DataFrame, min_sentences: int, min_words: int, keep=None) -> DataFrame:
    """``run, id, key, more, at, sentences``; ``keep`` is a filter on runs."""
    id_type = docs.schema["id"].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                doc, at, many, value = runs(find_words(piece.column("text")), min_sentences,
                                            min_words)
                if keep is not None:
                    hit = keep.value.holds(value)
                    doc, at, many, value = doc[hit], at[hit], many[hit], value[hit]
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.view(np.int64)),
                     *(piece.column(c).take(rows) for c in ("id", "key", "more")),
                     pa.array(at.astype(np.int32)), pa.array(many.astype(np.int32))],
                    names=["run", "id", "key", "more", "at", "sentences"])

    return docs.mapInArrow(
        emit, f"run long, id {id_type}, key long, more long, at int, sentences int")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the sentences listed in ``spans``."""
    for batch in batches:
        spans = batch.column("spans")
        texts, removed, dropped = [], [], []
        for i in range(batch.num_rows):
            if not spans[i].is_valid:
                texts.append(batch.column("text")[i].as_py())
                removed.append(0)
                dropped.append(0)
                continue
            words = find_words(batch.column("text").slice(i, 1))
            begins, first = sentences(words)
            gone = np.zeros(first[-1] + 1, np.int64)
            for span in spans[i].as_py():
                gone[span["start"]] += 1
                gone[span["start"] + span["sentences"]] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            # A sentence reaches to the start of the next one.
            cuts = np.append(words.starts, len(words.data))[begins]
            cuts[0] = 0
            data = words.data.tobytes()
            edges = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(int)))
            kept = [data[cuts[a]:cuts[b]] for a, b in zip(edges[::2], edges[1::2])]
            texts.append(b"".join(kept).decode().strip(" \t\n\v\f\r"))
            removed.append(int(gone.sum()))
            dropped.append(int(np.diff(begins)[gone].sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(texts, pa.string()), pa.array(removed, pa.int64()),
             pa.array(dropped, pa.int64())], names=["id", "text", "n_removed", "words_removed"])


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          min_sentences: int = MIN_SENTENCES,
                          min_words: int = MIN_WORDS) -> DataFrame:
    """``id, text, n_removed, words_removed``, one row per row of ``docs``.

    ``n_removed`` and ``words_removed`` count the sentences and words taken out of ``text``.
    """
    if min_sentences < 1 or min_words < 1:
        raise ValueError("min_sentences and min_words must be positive")
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")) \
               .withColumns(_keys())
    row = ["id", "key", "more"]
    place = F.struct(*row, "at")
    first = (_runs_of(docs, min_sentences, min_words).select("run", place.alias("place"))
             .groupBy("run").agg(F.min("place").alias("first"), F.max("place").alias("last"))
             .filter(~F.col("first").eqNullSafe(F.col("last"))).select("run", "first"))
    # Repeated runs are few: a file of them per shuffle partition would be mostly small ones.
    first = cut_lineage(first.coalesce(4 * docs.sparkSession.sparkContext.defaultParallelism))
    filter_ = docs.sparkSession.sparkContext.broadcast(bloom.build(first, "run"))
    again = (_runs_of(docs, min_sentences, min_words, filter_).join(first, "run")
             .filter(~place.eqNullSafe(F.col("first"))))
    spans = again.groupBy(*row).agg(
        F.collect_set(F.struct(F.col("at").alias("start"), "sentences")).alias("spans"))
    spans = spans.select(*[F.col(c).alias(f"span_{c}") for c in row], "spans")
    joined = docs.join(spans, (F.col("key") == F.col("span_key"))
                       & (F.col("more") == F.col("span_more"))
                       & F.col("id").eqNullSafe(F.col("span_id")), "left")
    id_type = docs.schema["id"].dataType.simpleString()
    return joined.select("id", "text", "spans").mapInArrow(
        _cut, f"id {id_type}, text string, n_removed long, words_removed long")

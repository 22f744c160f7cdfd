"""Benchmark decontamination by greedy string tiling.

Texts are lower-cased words (runs of letters and digits). Benchmark items and documents are
joined on shared seeds, runs of ``min_match`` words. For every pair whose shared seeds cover
enough of the item, the longest common run of words that is not marked yet is marked in both,
again and again, until none of ``min_match`` words is left (Running Karp-Rabin matching finds the
runs). A document contains an item when tiles cover at least ``threshold`` of the item's words, in
any order, so passages whose sentences were moved around are found too. Of items under
``WHOLE_UNDER`` words all words have to be covered, or a common phrase would be enough.

The seed join reads every document: a Bloom filter of the benchmark's seeds, of fixed size,
lets through only seeds that may be in a benchmark, and what passes is joined exactly. A
document is then represented by the words its seeds cover; everything else cannot match. An
item's most frequent seeds are not joined at all, as many as together cover too little of it for a
match, so an opening that many items and documents share makes no pairs.

Items with fewer than ``min_match`` words are found as a run of just these words. Items without
words are in no document. Missing texts are empty. Rows equal in id and text are one document (or
item). Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from civiltext.llm import bloom
from civiltext.llm.rows import row_key
from civiltext.llm.words import BASE, LOWER, NOT_ALNUM, find_words, mix, slices
from civiltext.sources.shared import cut_lineage

MIN_MATCH = 4
THRESHOLD = 0.5
WHOLE_UNDER = 9


def least_covered(n_words, threshold: float):
    """How many words of an item have to be covered; for numbers and for arrays."""
    return np.where(np.asarray(n_words) < WHOLE_UNDER, n_words, np.ceil(n_words * threshold))


def karp_rabin(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` tokens."""
    if len(tokens) < n:
        return np.zeros(0, np.uint64)
    value = np.zeros(len(tokens) - n + 1, np.uint64)
    for i in range(n):
        value = value * BASE + tokens[i:i + len(value)]
    return mix(value)


def greedy_tiles(item: np.ndarray, doc: np.ndarray,
                 min_match: int) -> list[tuple[int, int, int]]:
    """Tiles ``(item position, document position, words)``, longest first.

    Ties go to the smallest position in the item, then in the document.
    """
    seeds, windows = karp_rabin(item, min_match), karp_rabin(doc, min_match)
    order = np.argsort(seeds, kind="stable")
    low = np.searchsorted(seeds[order], windows, side="left")
    many = np.searchsorted(seeds[order], windows, side="right") - low
    j = np.repeat(np.arange(len(windows)), many)
    i = order[np.arange(len(j)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)]
    used_i, used_j = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    tiles = []
    while len(i):
        order = np.lexsort((i, j - i))
        i, j = i[order], j[order]
        breaks = np.ones(len(i), bool)
        breaks[1:] = (np.diff(j - i) != 0) | (np.diff(i) != 1)
        begin = np.flatnonzero(breaks)
        length = np.diff(np.append(begin, len(i))) + min_match - 1
        best = begin[length == length.max()]
        best = best[np.lexsort((j[best], i[best]))[0]]
        a, b, n = int(i[best]), int(j[best]), int(length.max())
        tiles.append((a, b, n))
        used_i[a:a + n] = True
        used_j[b:b + n] = True
        sums_i = np.concatenate([[0], np.cumsum(used_i)])
        sums_j = np.concatenate([[0], np.cumsum(used_j)])
        free = (sums_i[i + min_match] == sums_i[i]) & (sums_j[j + min_match] == sums_j[j])
        i, j = i[free], j[free]
    return tiles


def _tokens(items: DataFrame, id_type: str) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words = find_words(piece.column("text"), NOT_ALNUM, LOWER)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("key"), pa.array(words.counts),
                     pa.array([words.hashes[a:b].tobytes()
                               for a, b in zip(words.first, words.first[1:])], pa.binary())],
                    names=["item_id", "item", "n_words", "item_tokens"])

    return items.mapInArrow(emit, f"item_id {id_type}, item long, n_words long, "
                                  "item_tokens binary")


def _seeds(rows: DataFrame, key: str, tokens: str, min_match: int) -> DataFrame:
    """``seed, key``: windows of ``min_match`` tokens, each value once per row."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(karp_rabin(np.frombuffer(value.as_buffer(), np.uint64), min_match))
                     for value in batch.column(1)]
            keys = np.repeat(batch.column(0).to_numpy(), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found).view(np.int64)), pa.array(keys)],
                names=["seed", key])

    return rows.select(key, tokens).mapInArrow(emit, f"seed long, {key} long")


def _covered(docs: DataFrame, id_type: str, min_match: int, filter_) -> DataFrame:
    """Documents with seeds that may be in a benchmark, and the words these cover.

    Stretches of covered words are kept apart by a 0.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words = find_words(piece.column("text"), NOT_ALNUM, LOWER)
                doc, at, value = words.runs(min_match)
                hit = filter_.value.holds(value)
                doc, at = doc[hit], at[hit]
                if not len(doc):
                    continue
                step = np.zeros(len(words.hashes) + 1, np.int64)
                np.add.at(step, at, 1)
                np.add.at(step, at + min_match, -1)
                kept = np.cumsum(step)[:-1] > 0
                found, tokens = np.unique(doc), []
                for d in found:
                    a, b = words.first[d], words.first[d + 1]
                    place = np.flatnonzero(kept[a:b])
                    gaps = np.flatnonzero(np.diff(place) > 1) + 1
                    tokens.append(np.insert(words.hashes[a:b][place], gaps, 0).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id").take(pa.array(found)),
                     piece.column("key").take(pa.array(found)), pa.array(tokens, pa.binary())],
                    names=["id", "doc", "doc_tokens"])

    return docs.mapInArrow(emit, f"id {id_type}, doc long, doc_tokens binary")


def _cover(item: np.ndarray, seeds: np.ndarray, known: np.ndarray, min_match: int) -> np.ndarray:
    """Which words of an item the seeds in ``known`` cover; ``seeds`` are those of the item."""
    step = np.zeros(len(item) + 1, np.int64)
    at = np.flatnonzero(np.isin(seeds, known))
    np.add.at(step, at, 1)
    np.add.at(step, at + min_match, -1)
    return np.cumsum(step)[:-1] > 0


def _to_join(item: np.ndarray, by_use: np.ndarray, least: float, min_match: int) -> np.ndarray:
    """The seeds to look for, of those of an item, which come the most frequent first.

    Those left out cover less than ``least`` words together, so no document matches by them alone.
    """
    seeds = karp_rabin(item, min_match)
    covered, kept = np.zeros(len(item), bool), []
    for seed in by_use:
        more = covered | _cover(item, seeds, np.array([seed]), min_match)
        if more.sum() < least:
            covered = more
        else:
            kept.append(seed)
    return np.array(kept, np.uint64)


def _indexed(seeds: DataFrame, items: DataFrame, doc_seeds: DataFrame, min_match: int,
             threshold: float) -> DataFrame:
    """``seed, item``: the seeds by which documents are looked up."""
    used = (doc_seeds.groupBy("seed").agg(F.count("*").alias("docs"))
            .join(seeds.groupBy("seed").agg(F.count("*").alias("items")), "seed")
            .select("seed", (F.col("docs") * F.col("items")).alias("pairs")))
    listed = seeds.join(used, "seed", "left").groupBy("item").agg(F.sort_array(F.collect_list(
        F.struct(F.coalesce("pairs", F.lit(0)).alias("pairs"), "seed")), asc=False).alias("use"))
    rows = listed.select("item", F.transform("use", lambda u: u["seed"]).alias("use")) \
                 .join(items.select("item", "item_tokens"), "item")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for use, tokens in zip(batch.column("use"), batch.column("item_tokens")):
                item = np.frombuffer(tokens.as_buffer(), np.uint64)
                found.append(_to_join(item, use.values.to_numpy().view(np.uint64),
                                      float(least_covered(len(item), threshold)), min_match))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)),
                 batch.column("item").take(pa.array(np.repeat(np.arange(len(found)),
                                                              [len(f) for f in found])))],
                names=["seed", "item"])

    return rows.mapInArrow(choose, "seed long, item long")


def _tile(min_match: int, threshold: float):
    def tiles_of(item: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int]]:
        cover = _cover(item, karp_rabin(item, min_match), karp_rabin(doc, min_match), min_match)
        if cover.sum() < least_covered(len(item), threshold):
            return []
        return greedy_tiles(item, doc, min_match)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [tiles_of(np.frombuffer(a.as_buffer(), np.uint64),
                              np.frombuffer(b.as_buffer(), np.uint64))
                     for a, b in zip(batch.column("item_tokens"), batch.column("doc_tokens"))]
            matched = np.array([sum(t[2] for t in tiles) for tiles in found], np.int64)
            good = matched >= least_covered(batch.column("n_words").to_numpy(), threshold)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "doc", "item_id", "n_words")),
                 pa.array(matched), pa.array([len(tiles) for tiles in found], pa.int64()),
                 pa.array([max((t[2] for t in tiles), default=0) for tiles in found],
                          pa.int64())],
                names=["id", "doc", "item_id", "n_words", "matched", "tiles", "longest"]) \
                .filter(pa.array(good))

    return emit


def _short(docs: DataFrame, items: DataFrame, id_type: str, lengths: list[int]) -> DataFrame:
    """Documents with items of ``lengths`` words, all of them in a row."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [karp_rabin(np.frombuffer(t.as_buffer(), np.uint64), n)[0] for t, n in
                    zip(batch.column("item_tokens"), batch.column("n_words").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), batch.column("n_words"),
                 pa.array(np.array(runs, np.uint64).view(np.int64))],
                names=["item_id", "n_words", "run"])

    item_type = items.schema["item_id"].dataType.simpleString()
    short = cut_lineage(items.filter(F.col("n_words").isin(lengths))
                        .select("item_id", "n_words", "item_tokens")
                        .mapInArrow(whole, f"item_id {item_type}, n_words long, run long"))
    filter_ = docs.sparkSession.sparkContext.broadcast(bloom.build(short, "run"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words = find_words(piece.column("text"), NOT_ALNUM, LOWER)
                for n in lengths:
                    doc, _, value = words.runs(n)
                    hit = filter_.value.holds(value)
                    pairs = np.unique(np.stack([doc[hit].astype(np.uint64), value[hit]]), axis=1)
                    rows = pa.array(pairs[0].astype(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("id").take(rows), piece.column("key").take(rows),
                         pa.array(np.full(len(rows), n, np.int64)),
                         pa.array(pairs[1].view(np.int64))], names=["id", "doc", "n_words", "run"])

    found = docs.mapInArrow(emit, f"id {id_type}, doc long, n_words long, run long") \
                .dropDuplicates(["doc", "n_words", "run"])
    return found.join(short, ["n_words", "run"]).select(
        "id", "doc", "item_id", "n_words", F.col("n_words").alias("matched"),
        F.lit(1).cast("long").alias("tiles"), F.col("n_words").alias("longest"))


def contaminations(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", min_match: int = MIN_MATCH,
                   threshold: float = THRESHOLD) -> DataFrame:
    """``id, doc, item_id, n_words, matched, tiles, longest, coverage`` for every document and
    item whose tiles cover enough of the item; ``doc`` is ``row_key``."""
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"),
                       row_key(id_col, text_col).alias("key"))
    items = items.select(F.col(item_col).alias("id"),
                         F.coalesce(item_text_col, F.lit("")).alias("text"),
                         row_key(item_col, item_text_col).alias("key")).dropDuplicates(["key"])
    types = {name: df.schema["id"].dataType.simpleString()
             for name, df in (("doc", docs), ("item", items))}
    items = cut_lineage(_tokens(items, types["item"]))
    seeds = cut_lineage(_seeds(items, "item", "item_tokens", min_match))
    filter_ = docs.sparkSession.sparkContext.broadcast(bloom.build(seeds, "seed"))
    covered = cut_lineage(_covered(docs, types["doc"], min_match, filter_)
                          .dropDuplicates(["doc"]))
    doc_seeds = _seeds(covered, "doc", "doc_tokens", min_match)
    indexed = cut_lineage(_indexed(seeds, items, doc_seeds, min_match, threshold))
    pairs = doc_seeds.join(indexed, "seed").select("doc", "item").distinct() \
                     .join(items, "item").join(covered, "doc")
    found = pairs.select("id", "doc", "item_id", "n_words", "item_tokens", "doc_tokens") \
                 .mapInArrow(_tile(min_match, threshold),
                             f"id {types['doc']}, doc long, item_id {types['item']}, "
                             "n_words long, matched long, tiles long, longest long")
    # As many rows as there are lengths.
    lengths = sorted(r[0] for r in items.filter(F.col("n_words").between(1, min_match - 1))
                     .select("n_words").distinct().collect())
    if lengths:
        found = found.unionByName(_short(docs, items, types["doc"], lengths))
    return found.withColumn("coverage", F.col("matched") / F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", least_words: int = MIN_MATCH,
                      **options) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item; all columns stay.

    Items under ``least_words`` words drop nothing: a word or two stand in documents that have
    never seen the benchmark.
    """
    found = contaminations(docs, items, id_col, text_col, **options) \
        .filter(F.col("n_words") >= least_words).select("doc").distinct()
    return docs.join(found, row_key(id_col, text_col) == F.col("doc"), "left_anti")

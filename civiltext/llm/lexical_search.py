"""Ranked lexical search: documents are scanned by an Aho-Corasick automaton of all item terms.

Terms are runs of letters, digits and anything outside ASCII, A-Z lower-cased. A block of items
gives one automaton of their terms, each between two blanks; texts, with every other ASCII
character turned into a blank, are read by it once, and each match leads to the items that have
the term. There is no index of the documents. A first pass counts in how many documents each term
occurs; the second scores documents and keeps, per task and item, the ``k`` best, so that only
those are shuffled.

Items with equal terms in equal order are searched once. Blocks of items go to the executors one
after the other; their terms have ``BLOCK_BYTES`` on average, so their number grows with the items
and not their size (one item alone may be larger, it is never cut).

Missing and empty texts have no terms, in items and in documents; such items have no rows. Each
row of either table counts for itself, also where ids are missing or repeated; equal scores are
ordered by ascending id, missing ids last. Empty tables give empty results.
"""

from __future__ import annotations

import functools
import itertools
import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from civiltext.llm import words as w

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_BYTES = 2 << 20           # of terms in an automaton; its nodes take some fifty times that
CELLS = 1 << 22                 # scores held at once
MATCHES = 1 << 18               # matches listed at once
HELD = 1 << 17                  # candidates held before they are reduced to the best
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKED = bytes(32 if w.NOT_ALNUM[b] else w.LOWER[b] for b in range(256))


def term_list(text: str | Column) -> Column:
    """The terms of a text in order, with repeats; none for a missing text."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))


@dataclass
class Block:
    """Items of a block. ``items[starts[t]:starts[t + 1]]`` have term ``t``, ``repeats`` times."""

    keys: list[str]
    terms: list[str]
    starts: np.ndarray
    items: np.ndarray
    repeats: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    @classmethod
    def of(cls, rows: list[tuple[str, list[str]]]) -> Block:
        bags = [Counter(terms) for _, terms in rows]
        terms = sorted(set().union(*bags))
        number = {term: i for i, term in enumerate(terms)}
        found = sorted((number[term], item, n) for item, bag in enumerate(bags)
                       for term, n in bag.items())
        term, items, repeats = (np.array(c, np.int64) for c in zip(*found)) if found else \
            (np.zeros(0, np.int64),) * 3
        return cls([key for key, _ in rows], terms,
                   np.searchsorted(term, np.arange(len(terms) + 1)), items, repeats)

    def automaton(self):
        import ahocorasick
        guarded = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, term in enumerate(self.terms):
            guarded.add_word(f" {term} ", i)
        if self.terms:
            guarded.make_automaton()
        return guarded


@functools.lru_cache(maxsize=1)
def _automaton(name: str, block):
    return block.value.automaton()


def _sizes(column: pa.Array) -> np.ndarray:
    """How many terms each text has."""
    data, offsets = w.text_bytes(column)
    inside = ~w.NOT_ALNUM[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    return np.diff(np.concatenate([[0], np.cumsum(begins)])[offsets])


def _scan(automaton, column: pa.Array, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and how often it occurs there, in the order of texts and terms."""
    texts = [t.encode().translate(_BLANKED).decode() for t in column.to_pylist()]
    ends = np.cumsum([0, *(len(t) + 1 for t in texts)])
    matches = automaton.iter(f" {' '.join(texts)} ") if n_terms else iter(())
    pairs, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    while found := list(itertools.islice(matches, MATCHES)):
        last, term = (np.fromiter(c, np.int64, len(found)) for c in zip(*found))
        # A match ends with the blank after its term; the blank before a text is its place 0.
        text = np.searchsorted(ends, last - 1, side="right") - 1
        more, count = np.unique(text * n_terms + term, return_counts=True)
        both, place = np.unique(np.concatenate([pairs, more]), return_inverse=True)
        pairs, before = both, np.concatenate([n, count])
        n = np.zeros(len(both), np.int64)
        np.add.at(n, place, before)
    return pairs // max(n_terms, 1), pairs % max(n_terms, 1), n


def _statistics(docs: DataFrame, block) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and in how many documents each term occurs."""
    n_terms = len(block.value.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(block.value.name, block)
        seen, total, df = 0, 0, np.zeros(n_terms, np.int64)
        for batch in batches:
            for piece in w.slices(batch, "text"):
                column = piece.column("text")
                sizes = _sizes(column)
                seen, total = seen + int((sizes > 0).sum()), total + int(sizes.sum())
                _, term, _ = _scan(automaton, column, n_terms)
                df += np.bincount(term, minlength=n_terms)
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-2, -1, *found.tolist()], pa.int64()),
             pa.array([seen, total, *df[found].tolist()], pa.int64())], names=["term", "n"])

    counts = np.zeros(n_terms + 2, np.int64)
    for term, n in docs.select("text").mapInArrow(run, "term long, n long") \
                       .groupBy("term").agg(F.sum("n")).collect():
        counts[term] = n
    return int(counts[-2]), int(counts[-1]), counts[:n_terms]


class _Best:
    """The ``k`` best documents of each item among those seen."""

    def __init__(self, n_items: int, k: int, id_type: pa.DataType):
        self.k, self.schema = k, pa.schema([("item", pa.int64()), ("score", pa.int64()),
                                            ("id", id_type)])
        self.kept = self.schema.empty_table()
        self.waiting, self.n_waiting = [], 0
        self.least = np.ones(n_items, np.int64)

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        """``scores[d, i]``: of document ``d`` for item ``i``."""
        doc, item = np.nonzero(scores >= self.least)
        if len(doc):
            self.waiting.append(pa.table([pa.array(item), pa.array(scores[doc, item]),
                                          ids.take(pa.array(doc))], schema=self.schema))
            self.n_waiting += len(doc)
        if self.n_waiting > max(HELD, self.k * len(self.least)):
            self.reduce()

    def reduce(self) -> pa.Table:
        rows = pa.concat_tables([self.kept, *self.waiting]).combine_chunks()
        rows = rows.take(pc.sort_indices(
            rows, [("item", "ascending"), ("score", "descending"), ("id", "ascending")]))
        item = rows["item"].to_numpy()
        place = np.arange(len(item)) - np.searchsorted(item, item)
        self.kept, self.waiting, self.n_waiting = rows.filter(pa.array(place < self.k)), [], 0
        full = place == self.k - 1
        self.least[item[full]] = rows["score"].to_numpy()[full]
        return self.kept


def _scores(block: Block, weight: np.ndarray, m: np.ndarray, text: np.ndarray, term: np.ndarray,
            tf: np.ndarray) -> np.ndarray:
    """Scores of the texts ``0 .. len(m) - 1`` for all items."""
    scores = np.zeros((len(m), len(block.keys)), np.int64)
    share = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[text]))
    n_items = np.diff(block.starts)[term]
    ends = np.cumsum(n_items)
    at = 0
    while at < len(term):
        # As many pairs as lead to ``CELLS`` items, or one.
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CELLS)))
        n = n_items[at:stop]
        pair = np.repeat(np.arange(at, stop), n)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + block.starts[term[pair]]
        np.add.at(scores, (text[pair], block.items[place]), share[pair] * block.repeats[place])
        at = stop
    return scores


def _best_of_block(docs: DataFrame, block, k: int) -> DataFrame:
    """``key, rank, id, score`` for the items of a block."""
    spark = docs.sparkSession
    seen, total, df = _statistics(docs, block)
    weight = np.array([math.floor(1000 * math.log((2 * seen + 2) / (2 * n + 1)))
                       for n in df.tolist()], np.int64)
    weights = spark.sparkContext.broadcast(weight)
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value
        automaton, best = _automaton(items.name, block), None
        for batch in batches:
            best = best or _Best(len(items.keys), k, batch.schema.field("id").type)
            for piece in w.slices(batch, "text"):
                column, ids = piece.column("text"), piece.column("id")
                m = 25 + (75 * _sizes(column) * seen) // max(total, 1)
                text, term, tf = _scan(automaton, column, len(items.terms))
                step = max(1, CELLS // max(1, len(items.keys)))
                for a in range(0, len(m), step):
                    x, y = np.searchsorted(text, [a, a + step])
                    best.add(_scores(items, weights.value, m[a:a + step], text[x:y] - a, term[x:y],
                                     tf[x:y]), ids.slice(a, step))
        if best:
            kept = best.reduce()
            keys = pa.array(items.keys, pa.string()).take(kept["item"].combine_chunks())
            for part in pa.table([keys, kept["id"], kept["score"]],
                                 names=["key", "id", "score"]).to_batches(10_000):
                yield part

    found = docs.select("id", "text").mapInArrow(run, f"key string, id {kind}, score long")
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", k: int = 10,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, id, score``: the ``k`` documents that score highest for each item."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    asked = items.select(F.col(item_id_col).alias("item_id"),
                         term_list(F.col(item_text_col)).alias("terms")) \
                 .filter(F.size("terms") > 0) \
                 .withColumn("key", F.sha2(F.array_join("terms", " "), 256))
    distinct = asked.select("key", "terms").dropDuplicates(["key"])
    octets = F.octet_length(F.array_join(F.array_distinct("terms"), " "))
    size = distinct.agg(F.coalesce(F.sum(octets), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // block_bytes))
    number = F.pmod(F.xxhash64("key"), F.lit(n_blocks))
    found = []
    for i in range(n_blocks):
        rows = [tuple(r) for r in distinct.filter(number == i).collect()]
        found.append(_best_of_block(docs, spark.sparkContext.broadcast(Block.of(rows)), k))
    return functools.reduce(DataFrame.unionByName, found).join(asked.select("key", "item_id"), "key") \
        .select("item_id", "rank", "id", "score")

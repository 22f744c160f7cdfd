"""TF-IDF features of cleaned text.

Weights are ``1 + ln(tf)`` times ``ln((1 + n) / (1 + df)) + 1``, then scaled to length 1.
Only fitting shuffles: one partially aggregated count per term that is not rare. Turning a text
into its vector happens in the text's own row, a batch of texts at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.feature import NGram
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from civiltext.functions.barrier import rows_of
from civiltext.functions.patterns import WORD
from civiltext.functions.text import null_to_empty, strip_accents
from civiltext.operators import sketch
from civiltext.operators.broadcasts import is_small
from civiltext.operators.termcodes import codes_of, grams, pieces
from civiltext.sources.shared import PART_BYTES, in_parts, stored

MAX_FEATURES = 50_000
MIN_DF = 3
MAX_DF = 0.9
NGRAMS = (1, 2)
TERM_BYTES = 8 << 20    # of texts whose terms are counted by one task, about
COUNTED_BYTES = 4 << 20     # of terms and counts that a task adds up before it hands them on


def term_tokens(clean: Column) -> Column:
    """Tokens of two or more word characters, accents folded."""
    return F.regexp_extract_all(strip_accents(null_to_empty(clean)), F.lit(f"[{WORD}]{{2,}}"), F.lit(0))


def with_terms(df: DataFrame, clean_col: str, out: str = "terms",
               ngrams: tuple[int, int] = NGRAMS) -> DataFrame:
    """Append the n-grams of a text, formed after short tokens were dropped."""
    df = df.withColumn("_tokens", term_tokens(F.col(clean_col)))
    parts = []
    for n in range(ngrams[0], ngrams[1] + 1):
        if n == 1:
            parts.append("_tokens")
            continue
        df = NGram(n=n, inputCol="_tokens", outputCol=f"_grams{n}").transform(df)
        parts.append(f"_grams{n}")
    return df.withColumn(out, F.concat(*parts)).drop("_tokens", *parts)


def token_text(clean: Column) -> Column:
    """The tokens of a text with one blank between them."""
    return F.array_join(term_tokens(clean), " ")


def _added_up(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per term, in batches, from parts of ``term, tf, df``."""
    if parts:
        added = pa.Table.from_batches(parts).group_by("term", use_threads=False).aggregate(
            [("tf", "sum"), ("df", "sum")])
        yield from added.select(["term", "tf_sum", "df_sum"]) \
                        .rename_columns(["term", "tf", "df"]).to_batches(100_000)
        parts.clear()
        pa.default_memory_pool().release_unused()   # else a worker keeps it for what it does next


def term_counts(df: DataFrame, tokens_col: str, ngrams: tuple[int, int] = NGRAMS,
                may_pass: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """``term, tf`` (occurrences) and ``df`` (texts it occurs in), by one shuffle.

    Tasks add up the counts of some pieces of the texts at a time. ``may_pass`` tells, for codes of terms, which
    ones to count at all.
    """
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(0)):
                found = grams(piece, ngrams)
                kept = np.arange(len(found.code)) if may_pass is None else \
                    np.flatnonzero(may_pass(found.code))
                code, first, place, tf = np.unique(found.code[kept], return_index=True,
                                                   return_inverse=True, return_counts=True)
                # Each text once per term.
                once = np.unique(found.row[kept] * len(code) + place) % max(len(code), 1)
                df = np.bincount(once, minlength=len(code))
                for at in range(0, len(code), 100_000):
                    part = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [found.strings(kept[first[part]]).cast(pa.string()), pa.array(tf[part]),
                         pa.array(df[part])], names=["term", "tf", "df"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in counts(batches):
            held.append(part)
            size += part.nbytes
            if size > COUNTED_BYTES:
                yield from _added_up(held)
                held, size = [], 0
        yield from _added_up(held)

    octets = df.agg(F.coalesce(F.sum(F.octet_length(tokens_col)), F.lit(0))).first()[0]
    counted = df.select(tokens_col).mapInArrow(count, "term string, tf long, df long")
    if octets > PART_BYTES:
        # As many parts as the texts ask for: what one of them holds does not grow with the table.
        parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-octets // TERM_BYTES))
        counted = counted.repartition(parts, "term")
    return counted.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def prune(counts: DataFrame, texts: int, min_df: int = MIN_DF,
          max_df: float = MAX_DF) -> DataFrame:
    """Drop terms that are in too few or too many of the ``texts``."""
    return counts.filter((F.col("df") >= min_df) & (F.col("df") <= max_df * texts))


def frequent_counts(df: DataFrame, tokens_col: str, ngrams: tuple[int, int] = NGRAMS,
                    min_df: int = MIN_DF, cells: int = sketch.CELLS) -> DataFrame:
    """``term_counts`` of the terms in ``min_df`` texts or more; reads the texts twice.

    Most n-grams occur in one or two texts. A counting filter finds nearly all of them by a first
    pass over the texts; they never leave the task that read them, and only the rest is shuffled
    and counted exactly.
    """
    if min_df <= 1:
        return term_counts(df, tokens_col, ngrams)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for piece in pieces(batch.column(0)):
                found = grams(piece, ngrams)
                yield found.row, found.code

    counted = df.select(tokens_col).mapInArrow(
        lambda batches: sketch.count_rows(coded(batches), min_df, cells), sketch.COUNTED)
    bits = df.sparkSession.sparkContext.broadcast(sketch.reached(counted, min_df, cells))
    counts = term_counts(df, tokens_col, ngrams,
                         lambda codes: sketch.may_reach(bits.value, codes))
    return counts.filter(F.col("df") >= min_df)


RADIX_BITS = 8      # of a frequency that one histogram tells apart
RANKED = 100_000    # equally frequent terms that are ranked without another histogram


def _last_group(counts: DataFrame, group: Column, room: int, descending: bool) -> tuple:
    """The group in which the ``room``-th row stands, how many rows come before it and how many
    it has; groups are as many as the digits of a frequency or the characters there are."""
    sizes = sorted(((r.g, r.n) for r in counts.groupBy(group.alias("g"))
                    .agg(F.count("*").alias("n")).collect()), reverse=descending)
    before = 0
    for key, n in sizes:
        if before + n >= room:
            return key, before, n
        before += n
    raise ValueError("there are fewer rows than that")


def vocabulary(counts: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """The most frequent terms; ties go to the alphabetically first.

    No task sees all terms. Histograms of bounded size, over the digits of the frequencies and
    then over the characters of the terms that tie, tell where the vocabulary is full; all terms
    before are taken by a plain filter, and only those at that place are ranked.
    """
    n, highest = counts.agg(F.count("*"), F.max("tf")).first()
    if n <= max_features:
        return counts
    if not max_features:
        return counts.limit(0)
    room, low = max_features, 0
    shift = max(0, -(-highest.bit_length() // RADIX_BITS) - 1) * RADIX_BITS
    while shift >= 0:
        # The frequency looked for starts with the digits found so far.
        own = counts.filter(F.shiftright("tf", shift + RADIX_BITS) == low)
        low, before, size = _last_group(own, F.shiftright("tf", shift), room, descending=True)
        room, shift = room - before, shift - RADIX_BITS
    ties, kept, at = counts.filter(F.col("tf") == low), counts.filter(F.col("tf") > low), 0
    while size > max(RANKED, room):
        at += 1
        char = F.substring("term", at, 1)
        last, before, size = _last_group(ties, char, room, descending=False)
        kept, room = kept.unionByName(ties.filter(char < last)), room - before
        ties = ties.filter(char == last)
    return kept.unionByName(ties.orderBy("term").limit(room))


class Vectorizer:
    """What a task needs to turn texts into vectors: codes of the terms and their weights."""

    def __init__(self, terms: list[str], idf: list[float], ngrams: tuple[int, int]):
        codes = codes_of(terms)
        self.place = np.argsort(codes)
        self.codes, self.idf, self.ngrams = codes[self.place], np.asarray(idf), ngrams
        if (self.codes[1:] == self.codes[:-1]).any():
            raise ValueError("two terms share a code")

    def by_piece(self, tokens: pa.Array) -> Iterator[tuple]:
        """Which texts a piece has, and text (from 0 in the piece), term and weight of its entries, in
        the order of texts and terms; what is held at once goes by the size of a piece."""
        size, before = len(self.codes), 0
        for piece in pieces(tokens):
            found = grams(piece, self.ngrams)
            at = np.minimum(np.searchsorted(self.codes, found.code), size - 1)
            known = np.flatnonzero(self.codes[at] == found.code)
            pair, tf = np.unique(found.row[known] * size + self.place[at[known]],
                                 return_counts=True)
            row, idx = pair // size, pair % size
            weight = (1.0 + np.log(tf)) * self.idf[idx]
            norm = np.sqrt(np.bincount(row, weights=weight * weight, minlength=len(piece)))
            yield slice(before, before + len(piece)), row, idx, weight / norm[row]
            before += len(piece)

    def entries(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term and weight of all entries, in the order of texts and terms."""
        parts = [(row + texts.start, idx, weight)
                 for texts, row, idx, weight in self.by_piece(tokens)]
        return tuple(np.concatenate(c) for c in zip(*parts)) if parts else \
            (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

    def vectors(self, tokens: pa.Array) -> pa.Array:
        """Sparse vectors as Spark keeps them."""
        row, idx, weight = self.entries(tokens)
        n = len(tokens)
        starts = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())
        return pa.StructArray.from_arrays(
            [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, len(self.codes), np.int32)),
             pa.ListArray.from_arrays(starts, pa.array(idx, pa.int32())),
             pa.ListArray.from_arrays(starts, pa.array(weight))],
            names=["type", "size", "indices", "values"])

    def sums(self, tokens: pa.Array, weights: np.ndarray) -> np.ndarray:
        """For each text and each row of ``weights`` (a weight per term) the weighted sum."""
        found = np.zeros((len(tokens), len(weights)))
        for texts, row, idx, weight in self.by_piece(tokens):
            for i, own in enumerate(weights):
                found[texts, i] = np.bincount(row, weight * own[idx], texts.stop - texts.start)
        return found


@dataclass
class TfidfModel:
    """A fitted vocabulary (at most ``max_features`` terms) with its weights."""

    terms: list[str]
    idf: list[float]
    ngrams: tuple[int, int] = NGRAMS
    _sent: Broadcast | None = field(default=None, repr=False, compare=False)

    def sent(self, spark: SparkSession) -> Broadcast:
        """The vectorizer, sent to the executors once; it has a few numbers per term."""
        if self._sent is None:
            self._sent = spark.sparkContext.broadcast(
                Vectorizer(self.terms, self.idf, self.ngrams))
        return self._sent

    @classmethod
    def fit(cls, df: DataFrame, clean_col: str = "clean_text", **options) -> "TfidfModel":
        """A model of cleaned texts; their tokens are written once and deleted at the end."""
        tokens = in_parts(df.select(clean_col), clean_col).select(
            token_text(F.col(clean_col)).alias("tokens"))
        with stored(tokens, "tokens") as tokens:
            return cls.fit_tokens(tokens, "tokens", **options)

    @classmethod
    def fit_tokens(cls, df: DataFrame, tokens_col: str, max_features: int = MAX_FEATURES,
                   ngrams: tuple[int, int] = NGRAMS, min_df: int = MIN_DF,
                   max_df: float = MAX_DF, texts: int | None = None) -> "TfidfModel":
        """A model of texts given as ``token_text``, which are read three times."""
        n = df.count() if texts is None else texts
        counts = frequent_counts(df, tokens_col, ngrams, min_df)
        # Written once: the vocabulary reads the counts several times.
        with stored(prune(counts, n, min_df, max_df), "terms") as pruned:
            # Bounded: max_features rows, which the driver needs as a model.
            kept = sorted((r.term, r.df) for r in vocabulary(pruned, max_features).collect())
        if not kept:
            raise ValueError("no term is left; lower min_df or raise max_df")
        return cls([t for t, _ in kept],
                   [math.log((1 + n) / (1 + d)) + 1 for _, d in kept], ngrams)

    def transform(self, df: DataFrame, clean_col: str = "clean_text",
                  out: str = "features") -> DataFrame:
        """Append the feature vector; no shuffle."""
        return df.withColumn(out, self.vector(token_text(F.col(clean_col)), df.sparkSession))

    def vector(self, tokens: Column, spark: SparkSession) -> Column:
        """The feature vector of a text given as ``token_text``."""
        sent = self.sent(spark)

        def vectors(tokens: pa.Array) -> pa.Array:
            return sent.value.vectors(tokens)

        vectors.__annotations__ = {"tokens": pa.Array, "return": pa.Array}
        return F.arrow_udf(vectors, returnType=VectorUDT())(tokens)

    def weighted_sums(self, tokens: Column, spark: SparkSession, weights: np.ndarray) -> Column:
        """An array: for each row of a matrix of term weights, the product with the vector."""
        sent, weights = self.sent(spark), spark.sparkContext.broadcast(weights)

        def sums(tokens: pa.Array) -> pa.Array:
            found = sent.value.sums(tokens, weights.value)
            starts = np.arange(len(tokens) + 1) * found.shape[1]
            return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(found.ravel()))

        sums.__annotations__ = {"tokens": pa.Array, "return": pa.Array}
        return F.arrow_udf(sums, returnType="array<double>")(tokens)

    def table(self, spark: SparkSession) -> DataFrame:
        """``idx, term, idf``."""
        return spark.createDataFrame(pa.table(
            [pa.array(range(len(self.terms)), pa.int32()), pa.array(self.terms, pa.string()),
             pa.array(self.idf, pa.float64())], names=["idx", "term", "idf"]))

    def weights(self, df: DataFrame, id_col: str, clean_col: str = "clean_text") -> DataFrame:
        """``id, term, weight`` rows; the vocabulary is broadcast if its size allows."""
        return self.token_weights(
            df.select(id_col, token_text(F.col(clean_col)).alias("tokens")), id_col, "tokens")

    def token_weights(self, df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
        """``weights`` of texts given as ``token_text``."""
        vectors = df.select(id_col, self.vector(F.col(tokens_col), df.sparkSession).alias("v"))
        entries = rows_of(
            vectors.select(id_col, F.unwrap_udt("v").alias("v")), [id_col],
            F.arrays_zip(F.col("v.indices").alias("idx"), F.col("v.values").alias("weight")), "idx")
        names = self.table(df.sparkSession).select("idx", "term")
        names = F.broadcast(names) if is_small(names, ["term"]) else names
        return entries.join(names, "idx").select(id_col, "term", "weight")

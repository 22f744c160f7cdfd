"""Toxicity by compression distance between two dictionaries.

Labels belong to documents, so which stretches of a toxic document are the toxic ones is
learned first: words, and beginnings of words, whose document frequency in toxic documents
far exceeds that in ordinary ones (counted over all labelled training documents) mark a word
as toxic. Zstandard dictionaries, which are lists of words, are then made, the commonest words
last, where references are shortest: one of the ordinary words that occur in most documents, and
as many as needed of toxic words, each followed by the same ordinary words, so that ordinary text
compresses alike. Every marked word is in one of them, however many there are.

A document is compressed in windows of ``WINDOW`` words, each ``STEP`` words further, once with
each dictionary. What the best toxic dictionary saves, over the windows, makes a few features; a
logistic curve, fitted on labelled documents that no dictionary was trained on, turns them
into a score. Scores depend on the text alone.

Missing and empty texts have no windows and get the score of a document without savings.
Without labels of both kinds the score is the share of toxic labels (0 without labels). Labels
that are missing are not used; of several labels for an id the largest counts. Rows are scored
one by one: equal texts have equal scores. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from civiltext.llm.words import find_words, slices
from civiltext.operators.features import vocabulary
from civiltext.operators.sampling import take_per_stratum
from civiltext.sources.shared import cut_lineage

WINDOW, STEP = 6, 6            # words
ORDINARY_BYTES = 64_000        # of the ordinary dictionary
TOXIC_BYTES = 64_000           # of a toxic one; further words go to further dictionaries
LEVEL = 12
SHORTEST, LONGEST = 4, 8       # code points of word beginnings
MIN_DOCUMENTS = 4              # toxic documents a term must occur in
MIN_DEVIATIONS = 6.0           # above the expected number of toxic documents
MIN_LOG_RATIO = 2.0            # of its shares in toxic and ordinary documents
CALIBRATION_ROWS = 20_000      # labelled documents the curve is fitted on, at most
DECISION = 0.3
FOLDS = 4


def fold(id_col: Column) -> Column:
    """A quarter of the ids each: 0 and 1 train dictionaries, 3 calibrates, 2 is held out."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(FOLDS)).cast("int")


def _words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), 1))


def _beginnings(word: Column) -> Column:
    """A word and its beginnings; a beginning that is cut off ends in ``*``."""
    cut = F.transform(F.sequence(F.lit(SHORTEST), F.lit(LONGEST)),
                      lambda n: F.when(F.length(word) > n,
                                       F.concat(F.substring(word, F.lit(1), n), F.lit("*"))))
    return F.filter(F.concat(F.array(word), cut), lambda t: t.isNotNull())


def term_counts(labelled: DataFrame) -> DataFrame:
    """``term, toxic, n``: in how many toxic documents a word or a beginning of words is, and in
    how many of all. A document counts once for a beginning, however many words of it have it."""
    terms = F.array_distinct(F.flatten(F.transform(_words(F.col("text")), _beginnings)))
    return (labelled.select("toxic", F.explode(terms).alias("term"))
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")))


def toxic_words(counts: DataFrame) -> DataFrame | None:
    """``term, toxic`` of the words that mark toxic documents, from ``term_counts``.

    A word is marked by itself or by one of its beginnings. None without documents of both kinds.
    """
    words = counts.filter(~F.col("term").endswith("*"))
    toxic, n = words.agg(F.sum("toxic"), F.sum("n")).first()
    if not toxic or toxic == n:
        return None
    share = toxic / n
    expected = F.col("n") * share
    above = (F.col("toxic") - expected) / F.sqrt(expected * (1 - share))
    ratio = F.log((F.col("toxic") + 0.5) / (toxic + 1)) \
        - F.log((F.col("n") - F.col("toxic") + 0.5) / (n - toxic + 1))
    found = counts.filter((F.col("toxic") >= MIN_DOCUMENTS) & (above > MIN_DEVIATIONS)
                          & (ratio > MIN_LOG_RATIO)).select(F.col("term").alias("found"))
    return (words.filter("toxic > 0")
            .select("term", "toxic", F.explode(_beginnings(F.col("term"))).alias("found"))
            .join(found, "found", "left_semi").select("term", "toxic").distinct())


def _packed(words: list[bytes]) -> bytes:
    """A dictionary of ``words``, the first one last."""
    return b"".join(reversed(words)) + b" " * bool(words)


def _dictionary(counts: DataFrame, number: Column, size: int) -> bytes:
    """The words with the highest ``number``, highest last, up to ``size`` bytes.

    A word has at least two bytes here, so at most ``size / 2`` words come to the driver.
    """
    listed = counts.filter(~F.col("term").endswith("*")) \
                   .select("term", number.alias("tf")).filter("tf > 0")
    top = sorted(vocabulary(listed, size // 2).collect(), key=lambda r: (-r.tf, r.term))
    out, room = [], size
    for row in top:
        word = b" " + row.term.encode()
        if len(word) > room:
            break
        out.append(word)
        room -= len(word)
    return _packed(out)


def _toxic_dictionaries(marked: DataFrame, size: int) -> tuple[bytes, ...]:
    """All marked words, the commonest first, in dictionaries of some ``size`` bytes each."""
    parts, room = [[]], size
    for row in sorted(marked.collect(), key=lambda r: (-r.toxic, r.term)):
        word = b" " + row.term.encode()
        if len(word) > room and parts[-1]:
            parts.append([])
            room = size
        parts[-1].append(word)
        room -= len(word)
    return tuple(map(_packed, parts))


@dataclass
class CompressionModel:
    """The dictionaries and the curve that turns savings into a score."""

    ordinary: bytes = b""
    toxic: tuple[bytes, ...] = (b"",)
    means: np.ndarray = field(default_factory=lambda: np.zeros(6))
    scales: np.ndarray = field(default_factory=lambda: np.ones(6))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(7))

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        """One for each dictionary, the ordinary one first; lengths hold nothing but
        compressed text."""
        out = []
        for content in (self.ordinary, *(part + self.ordinary for part in self.toxic)):
            settings = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, source_size=64, dict_size=len(content),
                format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False,
                write_checksum=False, write_dict_id=False)
            trained = zstandard.ZstdCompressionDict(
                content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            trained.precompute_compress(compression_params=settings)
            out.append(zstandard.ZstdCompressor(dict_data=trained, compression_params=settings))
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        z = (features - self.means) / self.scales @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _lengths(compressor: zstandard.ZstdCompressor, data: bytes,
             windows: np.ndarray) -> np.ndarray:
    parts = zstandard.BufferWithSegments(data, windows.astype(np.uint64).tobytes())
    out = compressor.multi_compress_to_buffer(parts, threads=1)
    return np.fromiter((len(out[i]) for i in range(len(out))), np.int64, len(out))


def savings(column: pa.Array, compressors, window: int = WINDOW, step: int = STEP) -> np.ndarray:
    """Features of each text: how many bytes the best toxic dictionary saves on its windows."""
    words = find_words(column)
    n = len(words.counts)
    many = np.where(words.counts > 0, np.maximum(0, -(-(words.counts - window) // step)) + 1, 0)
    doc = np.repeat(np.arange(n), many)
    first = words.first[doc] + step * (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many,
                                                                       many))
    last = np.minimum(first + window, words.first[doc + 1]) - 1
    saved = np.zeros(len(doc))
    if len(doc):
        # A blank at both ends, as around the words of the dictionaries.
        start = words.starts[first]
        size = words.ends[last] - start + 2
        text = words.data.copy()
        text[(text >= 65) & (text <= 90)] += 32
        text[(text >= 9) & (text <= 13)] = 32
        padded = b" " + text.tobytes() + b" "
        windows = np.stack([start, size], axis=1)
        plain, *toxic = (_lengths(c, padded, windows) for c in compressors)
        saved = np.maximum(plain - np.min(toxic, axis=0), 0).astype(float)

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, values, minlength=n)[:n] if len(doc) else np.zeros(n)

    most = np.zeros(n)
    np.maximum.at(most, doc, saved)
    total = per_text(saved)
    return np.stack([np.log1p(most), np.log1p(total), np.log1p(per_text(saved >= 2)),
                     np.log1p(per_text(saved >= 4)), np.log1p(many),
                     np.log1p(100 * total / (many + 10))], axis=1)


def _fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Logistic regression by Newton's method; the intercept comes first."""
    x = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -500, 500)))
        curvature = (x.T * (p * (1 - p))) @ x + penalty
        change = np.linalg.solve(curvature, x.T @ (y - p) - ridge * weights)
        weights += change
        if np.abs(change).max() < 1e-9:
            break
    return weights


def _with_features(docs: DataFrame, model: CompressionModel, keep: list[str],
                   finish) -> DataFrame:
    """``keep`` and what ``finish(features)`` makes of the features of column ``text``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = sent.value
        compressors = here.compressors()
        for batch in batches:
            for piece in slices(batch, "text"):
                out = finish(here, savings(piece.column("text"), compressors))
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in keep), out], names=[*keep, "out"])

    fields = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    kind = "array<double>" if finish is _feature_lists else "double"
    return docs.select(*keep, "text").mapInArrow(run, f"{fields}, out {kind}")


def _feature_lists(model: CompressionModel, features: np.ndarray) -> pa.Array:
    return pa.array(features.tolist(), pa.list_(pa.float64()))


def _scores(model: CompressionModel, features: np.ndarray) -> pa.Array:
    return pa.array(model.score(features))


def usable_labels(labels: DataFrame, id_col: str = "doc_id",
                  label_col: str = "toxic") -> DataFrame:
    """``label_id, toxic, fold`` of the labels outside the held-out quarter."""
    return (labels.select(F.col(id_col).alias("label_id"), F.col(label_col).alias("toxic"))
            .filter("label_id IS NOT NULL AND toxic IS NOT NULL")
            .groupBy("label_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
            .withColumn("fold", fold(F.col("label_id"))).filter("fold <> 2"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", calibration_rows: int = CALIBRATION_ROWS) -> CompressionModel:
    """Train on the documents that ``labels`` covers.

    Counts for the dictionaries are taken over all documents of folds 0 and 1; their texts are
    shuffled once (labels grow with the corpus, so they are never broadcast). The curve is
    fitted on documents of fold 3, on at most ``calibration_rows`` of them, chosen by a hash of
    the id, so their labels may be sent to every executor.
    """
    labels = cut_lineage(usable_labels(labels, id_col, label_col))
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    same = F.col("id") == F.col("label_id")
    counts = cut_lineage(term_counts(docs.filter(fold(F.col("id")) < 2)
                                     .join(labels.filter("fold < 2").hint("merge"), same)))
    model, ordinary = CompressionModel(), counts
    marked = toxic_words(counts)
    if marked is not None:
        marked = cut_lineage(marked)
        model.toxic = _toxic_dictionaries(marked, TOXIC_BYTES)
        # What stands in both dictionaries saves nothing.
        ordinary = counts.join(marked.select("term"), "term", "left_anti")
    model.ordinary = _dictionary(ordinary, F.col("n") - F.col("toxic"), ORDINARY_BYTES)
    chosen = labels.filter("fold = 3").withColumn("any", F.lit(1))
    if chosen.count() > calibration_rows:
        chosen = take_per_stratum(chosen, "label_id", "any", {1: calibration_rows})
    chosen = chosen.select("label_id", "toxic")
    rows = docs.filter(fold(F.col("id")) == 3).join(F.broadcast(chosen), same)
    # A row per label chosen, however often its id stands in ``docs``.
    rows = (_with_features(rows, model, ["id", "toxic"], _feature_lists).groupBy("id")
            .agg(F.max("toxic").alias("toxic"), F.min("out").alias("out")).collect())
    y = np.array([r.toxic for r in rows], float)
    share = float(y.mean()) if len(y) else 0.0
    if 0 < share < 1:
        x = np.array([r.out for r in rows])
        model.means, model.scales = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
        model.weights = _fit_curve((x - model.means) / model.scales, y)
    else:
        model.weights[0] = 500.0 if share else -500.0
    return model


def score(docs: DataFrame, model: CompressionModel, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``id, score``, one row per row of ``docs``."""
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return _with_features(docs, model, ["id"], _scores).withColumnRenamed("out", "score")


def drop_toxic(docs: DataFrame, model: CompressionModel, text_col: str = "text",
               decision: float = DECISION) -> DataFrame:
    """``docs`` without the documents that score ``decision`` or more; all columns stay."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def clean(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        here = sent.value
        compressors = here.compressors()
        for column in columns:
            batch = pa.RecordBatch.from_arrays([column], names=["text"])
            kept = [here.score(savings(piece.column(0), compressors)) < decision
                    for piece in slices(batch, "text")]
            yield pa.array(np.concatenate(kept) if kept else np.zeros(0, bool))

    return docs.filter(clean(F.coalesce(text_col, F.lit(""))))

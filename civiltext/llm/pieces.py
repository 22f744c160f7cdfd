"""SentencePiece encoding and decoding: Viterbi over an Aho-Corasick automaton.

An automaton over all pieces of a vocabulary reads a text once. Each match, found by following
output links, relaxes the best score at its end from the one at its start; the best path gives
the pieces with the highest sum of scores (ties: the longer last piece, at every position).

Spaces are written as U+2581 and one is put before a text that is not empty, as SentencePiece
does. Characters that are no piece, and U+2581 itself, become byte pieces, so that decoding
gives back exactly the text. As no piece reaches from one word into the next, the best path of
a text is that of its words one after the other; the paths of short words are kept per worker.

Missing and empty texts have no pieces. Rows are handled one by one.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "piece_bpe_32k.model"
CACHE_BYTES = 110 << 20         # of words kept per Python worker
CACHED_LENGTH = 64              # code points; longer words are not kept
_ENTRY_BYTES = 220              # of a word and its pieces, besides some eight for each code point
SPACE = "▁"
_LITERAL = "\ud800"            # stands for U+2581 in a text; no text holds a lone surrogate


class PieceCodec:
    def __init__(self, vocabulary: str):
        import ahocorasick
        import public_tokenizers
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(
            model_file=public_tokenizers.path(vocabulary))
        size = model.get_piece_size()
        self.pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in range(size)
                       if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                               or model.is_unused(i))}
        self.bytes = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(size)
                      if model.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        self.automaton = ahocorasick.Automaton()
        for piece, (i, score) in self.pieces.items():
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        alone = "".join(re.escape(p) for p in self.pieces if len(p) == 1)
        self.stretches = re.compile(f"[{alone}]+|[^{alone}]")
        #: Whether a piece may reach over the start of a word.
        self.crosses = any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.cuts = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        table = {i: p.replace(SPACE, " ").encode() for p, (i, _) in self.pieces.items()}
        table |= {i: bytes([b]) for b, i in self.bytes.items()}
        self.table = [table.get(i, b"") for i in range(size)]
        self.known: dict[str, bytes] = {}
        self.held = 0

    def best_path(self, text: str) -> list[int]:
        """Pieces of a text all of whose characters are pieces."""
        n = len(text)
        best = [0.0] + [float("-inf")] * n
        came = [None] * (n + 1)
        for last, (length, score, piece) in self.automaton.iter(text):
            end = last + 1
            total = best[end - length] + score
            if total > best[end] or total == best[end] and length > came[end][0]:
                best[end] = total
                came[end] = (length, piece)
        path = []
        while n:
            length, piece = came[n]
            path.append(piece)
            n -= length
        return path[::-1]

    def _spell(self, part: str) -> list[int]:
        return [self.bytes[b] for b in part.replace(_LITERAL, SPACE).encode()]

    def _word(self, word: str) -> bytes:
        out = []
        for part in self.stretches.findall(word):
            out += self.best_path(part) if part[0] in self.pieces else self._spell(part)
        coded = np.array(out, "<i4").tobytes()
        if len(word) <= CACHED_LENGTH:
            if self.held > CACHE_BYTES:
                self.known.clear()
                self.held = 0
            self.known[word] = coded
            self.held += _ENTRY_BYTES + 8 * len(word)
        return coded

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if SPACE in text:
            text = text.replace(SPACE, _LITERAL)
        text = SPACE + text.replace(" ", SPACE)
        words = [text] if self.crosses else self.cuts.findall(text)
        known = self.known.get
        return np.frombuffer(b"".join([known(w) or self._word(w) for w in words]), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of pieces."""
        table = self.table
        return b"".join([table[i] for i in ids.tolist()])[1:].decode()


@functools.cache
def codec(vocabulary: str = VOCABULARY) -> PieceCodec:
    return PieceCodec(vocabulary)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           vocabulary: str = VOCABULARY) -> DataFrame:
    """``id, pieces``: piece ids of each text; other columns are not read."""
    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        found = [codec(vocabulary).encode(t) for t in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, found)])
        return pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))

    return docs.select(F.col(id_col).alias("id"),
                       run(F.coalesce(text_col, F.lit(""))).alias("pieces"))


def decode(encoded: DataFrame, id_col: str = "id", pieces_col: str = "pieces",
           vocabulary: str = VOCABULARY) -> DataFrame:
    """``id, text`` from piece ids; missing pieces give an empty text."""
    @F.arrow_udf("string")
    def run(pieces: pa.Array) -> pa.Array:
        return pa.array([codec(vocabulary).decode(p.values.to_numpy()) if p.is_valid else ""
                         for p in pieces], pa.string())

    return encoded.select(F.col(id_col).alias("id"), run(F.col(pieces_col)).alias("text"))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               vocabulary: str = VOCABULARY) -> DataFrame:
    """``id, n_pieces, n_byte_pieces, ids_crc32, exact``: what encoding gives, and whether
    decoding gives back the text; one pass over the texts, nothing but digests leaves it."""
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary)
        spelled = np.zeros(len(coder.table), bool)
        spelled[list(coder.bytes.values())] = True
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                ids = coder.encode(text)
                rows.append((len(ids), int(spelled[ids].sum()), zlib.crc32(ids.tobytes()),
                             coder.decode(ids) == text))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, pa.int64()) for c in columns[:3]),
                 pa.array(columns[3], pa.bool_())],
                names=["id", "n_pieces", "n_byte_pieces", "ids_crc32", "exact"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n_pieces long, n_byte_pieces long, ids_crc32 long, "
                                "exact boolean")

"""Byte-level BPE encoding and decoding through a SentencePiece model built from the ranks.

A vocabulary of byte strings and ranks is written out as a SentencePiece BPE model, with no
training: each byte string becomes a piece, its bytes written as printable characters one for
one, its score the negative rank; the normaliser is the identity. SentencePiece merges the pair
whose piece scores best, leftmost first, which is the merge of lowest rank. Texts are cut into
pre-tokens by the vocabulary's pattern, and every pre-token is encoded on its own; one that is a
piece as a whole is that piece, as the rank files' own library has it. Decoding maps ids back to
bytes.

Missing and empty texts have no ids. Rows are handled one by one; equal rows give equal results.
A text longer than ``STRETCH`` is cut where white space follows something else, where no
pre-token can reach across, so its words are never listed at once. Pre-tokens already seen are
kept by worker, up to ``CACHE_BYTES``; those over ``CACHED_LENGTH`` code points never are.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from civiltext.llm import words as w

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
STRETCH = 1 << 20               # code points
CACHE_BYTES = 48 << 20
CACHED_LENGTH = 64
_ENTRY_BYTES = 200              # of a cached word besides its characters and ids

# Field numbers and values of the SentencePiece model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE, _NORMAL, _UNKNOWN = 1, 2, 3, 1, 2
_MODEL_TYPE, _BPE = 3, 2
_NAME, _DUMMY_PREFIX, _EXTRA_BLANKS, _ESCAPE_BLANKS = 1, 3, 4, 5


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def printable_bytes() -> list[str]:
    """A printable character for each byte: itself where it is one, else one from U+0100 on."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


def read_ranks(vocabulary: str) -> dict[bytes, int]:
    """Byte strings and ranks of a vocabulary file."""
    import public_tokenizers
    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        return {base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in lines if line.strip())}


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """A SentencePiece BPE model whose piece ids are the ranks."""
    spelled = printable_bytes()
    by_rank = sorted(ranks, key=ranks.get)
    if [ranks[token] for token in by_rank] != list(range(len(ranks))):
        raise ValueError("ranks must be the numbers from 0 on")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every byte must have a rank")
    pieces = [_block(_PIECE, "".join(spelled[b] for b in token).encode())
              + _varint(_SCORE << 3 | 5) + struct.pack("<f", -rank) + _number(_TYPE, _NORMAL)
              for rank, token in enumerate(by_rank)]
    # The format wants a piece for unknown characters; no byte is one.
    pieces.append(_block(_PIECE, b"<unk>") + _number(_TYPE, _UNKNOWN))
    identity = _block(_NAME, b"identity") + b"".join(
        _number(field, 0) for field in (_DUMMY_PREFIX, _EXTRA_BLANKS, _ESCAPE_BLANKS))
    return (b"".join(_block(_PIECES, p) for p in pieces)
            + _block(_TRAINER, _number(_MODEL_TYPE, _BPE)) + _block(_NORMALIZER, identity))


CLASSES = (r"\p{L}", r"\p{N}", r"\s")


def members(kind: str) -> np.ndarray:
    """Code points of a Unicode class by the tables of the rank files' own library."""
    import tiktoken
    single = tiktoken.Encoding(kind, pat_str=kind, special_tokens={},
                               mergeable_ranks={bytes([b]): b for b in range(256)})
    return np.array([*map(ord, single.decode(single.encode_ordinary(_every())))])


def _every() -> str:
    return "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))


def ranges(points: np.ndarray) -> str:
    """Ascending code points as the inside of a character class."""
    gaps = np.flatnonzero(np.diff(points) > 1)
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in zip(
        points[np.append(0, gaps + 1)], points[np.append(gaps, len(points) - 1)]))


class Cutter:
    """Pre-tokens of a text.

    Libraries know different versions of Unicode, and what is a letter to one only would cut
    words at other places. Texts with such characters are cut by the pattern with its classes
    written out; this takes longer, so all others are cut by the pattern as it is.
    """

    def __init__(self, pattern: str):
        known = {kind: members(kind) for kind in CLASSES}
        self.pattern = regex.compile(pattern)
        self.spelled_out = re.compile(self._spell(pattern, known))
        self.seam = re.compile(self._spell(r"(?<=\S)\s", known))
        other = [np.setxor1d(points, [*map(ord, regex.findall(kind, _every()))])
                 for kind, points in known.items()]
        other = ranges(np.unique(np.concatenate(other)).astype(int)) if any(map(len, other)) else ""
        self.differing = re.compile(f"[{other}]" if other else r"(?!)")

    @staticmethod
    def _spell(pattern: str, known: dict[str, np.ndarray]) -> str:
        classes = {kind: ranges(points) for kind, points in known.items()}
        out, inside = [], False
        for part in re.split(r"(\\p\{\w\}|\\.|\[|\])", pattern):
            inside = (inside or part == "[") and part != "]"
            if part == r"\S":
                out.append(f"[^{classes[part.lower()]}]")
            elif part in classes:
                out.append(classes[part] if inside else f"[{classes[part]}]")
            else:
                out.append(part)
        return "".join(out)

    def cut(self, text: str) -> list[str]:
        differs = not text.isascii() and self.differing.search(text)
        return (self.spelled_out if differs else self.pattern).findall(text)

    def stretches(self, text: str) -> Iterator[str]:
        """A text in parts of ``STRETCH`` code points or somewhat more, cut between pre-tokens."""
        start = 0
        while len(text) - start > STRETCH and (seam := self.seam.search(text, start + STRETCH)):
            yield text[start:seam.start()]
            start = seam.start()
        yield text[start:] if start else text


class ByteCodec:
    def __init__(self, vocabulary: str):
        import public_tokenizers
        import sentencepiece
        self.ranks = read_ranks(vocabulary)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.ranks))
        self.spelling = dict(enumerate(printable_bytes()))
        self.cutter = Cutter(public_tokenizers.PATTERN)
        self.table = pa.array(sorted(self.ranks, key=self.ranks.get), pa.large_binary())
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct pre-tokens, as little-endian 32-bit integers."""
        spelled = [word.encode() for word in words]
        coded = [self.ranks.get(word) for word in spelled]
        merged = [at for at, rank in enumerate(coded) if rank is None]
        found = self.model.encode(
            [spelled[at].decode("latin-1").translate(self.spelling) for at in merged],
            out_type=int, num_threads=1)
        for at, ids in zip(merged, found):
            coded[at] = ids
        coded = [[x] if isinstance(x, int) else x for x in coded]
        data = np.fromiter(itertools.chain.from_iterable(coded), "<u4").tobytes()
        ends = np.cumsum([0, *map(len, coded)]) * 4
        return [data[a:b] for a, b in itertools.pairwise(ends.tolist())]

    def _look_up(self, words: set[str]) -> dict[str, bytes]:
        """A table that has all of ``words``; long ones are in this table only."""
        if self.known_bytes > CACHE_BYTES:
            self.known, self.known_bytes = {}, 0
        known = self.known
        new = [word for word in words if word not in known]
        passing = {}
        for word, coded in zip(new, self._encode_words(new)):
            if len(word) <= CACHED_LENGTH:
                known[word] = coded
                self.known_bytes += _ENTRY_BYTES + 4 * len(word) + len(coded)
            else:
                passing[word] = coded
        if passing:
            passing |= {word: known[word] for word in words if word not in passing}
        return passing or known

    def _portions(self, texts: list[str]) -> Iterator[list[tuple[int, str]]]:
        """Texts or parts of them, with their numbers, about ``STRETCH`` code points at a time."""
        portion, size = [], 0
        for at, text in enumerate(texts):
            for part in self.cutter.stretches(text):
                portion.append((at, part))
                size += len(part)
                if size >= STRETCH:
                    yield portion
                    portion, size = [], 0
        yield portion

    def encode(self, texts: list[str]) -> tuple[bytes, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        coded, sizes = [], np.zeros(len(texts), np.int64)
        for portion in self._portions(texts):
            words = [self.cutter.cut(text) for _, text in portion]
            table = self._look_up(set(itertools.chain.from_iterable(words)))
            for (at, _), own in zip(portion, words):
                part = b"".join([table[word] for word in own])
                coded.append(part)
                sizes[at] += len(part) // 4
        return b"".join(coded), sizes

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The bytes that ids stand for, and where those of each text start and end.

        Numbers that are no ids stand for no bytes.
        """
        ids = ids.astype(np.int64)
        wrong = (ids < 0) | (ids >= len(self.table))
        found = self.table.take(pa.array(ids, mask=wrong) if wrong.any() else pa.array(ids))
        _, ends, data = found.buffers()
        ends = np.frombuffer(ends, np.int64)[:len(ids) + 1]
        return memoryview(data or b""), ends[np.concatenate([[0], np.cumsum(sizes)])]


@functools.cache
def codec(vocabulary: str = VOCABULARY) -> ByteCodec:
    return ByteCodec(vocabulary)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           vocabulary: str = VOCABULARY) -> DataFrame:
    """``id, ids``: token ids of each text; other columns are not read."""
    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        ids, sizes = codec(vocabulary).encode(texts.to_pylist())
        return pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
            pa.array(np.frombuffer(ids, "<i4")))

    return docs.select(F.col(id_col).alias("id"),
                       run(F.coalesce(text_col, F.lit(""))).alias("ids"))


def decode(encoded: DataFrame, id_col: str = "id", ids_col: str = "ids",
           vocabulary: str = VOCABULARY) -> DataFrame:
    """``id, bytes, text`` from token ids.

    Missing ids give no bytes, as do numbers that are none; ``text`` has U+FFFD where bytes are
    no UTF-8.
    """
    @F.arrow_udf("struct<bytes binary, text string>")
    def run(ids: pa.Array) -> pa.Array:
        rows = [np.array([i for i in row or () if i is not None], np.int64)
                for row in ids.to_pylist()]
        data, ends = codec(vocabulary).decode(
            np.concatenate([np.zeros(0, np.int64), *rows]), np.array([len(r) for r in rows], int))
        cut = [bytes(data[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        return pa.StructArray.from_arrays(
            [pa.array(cut, pa.binary()),
             pa.array([c.decode("utf-8", "replace") for c in cut], pa.string())], ["bytes", "text"])

    return encoded.select(F.col(id_col).alias("id"), run(F.col(ids_col)).alias("found")) \
                  .select("id", "found.bytes", "found.text")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               vocabulary: str = VOCABULARY) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of the bytes they
    decode to; one pass over the texts, nothing but digests leaves it."""
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def digests(data, ends) -> pa.Array:
        return pa.array([hashlib.sha256(data[a:b]).hexdigest()
                         for a, b in zip(ends[:-1], ends[1:])], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary)
        for batch in batches:
            for piece in w.slices(batch, "text"):
                ids, sizes = coder.encode(piece.column("text").to_pylist())
                bounds = 4 * np.concatenate([[0], np.cumsum(sizes)])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(sizes), digests(memoryview(ids), bounds),
                     digests(*coder.decode(np.frombuffer(ids, "<u4"), sizes))],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, "
                                "decoded_sha256 string")

"""Token ids of a corpus in entropy-coded segments, in ascending order of document ids.

``write_tokens`` encodes whole texts with a byte-pair tokenizer, ends each document with
``end_id`` and writes segments (see ``rans``) as rows of a Parquet dataset: ``part, seq`` give
their order, ``start`` the tokens before a segment within its part. ``read_tokens`` decodes
segments independently of each other.

Missing ids come first, equal ids are ordered by text; a missing text is an empty one, of
which only the end id is stored. Other columns are not read.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from civiltext.llm import rans
from civiltext.llm.words import BLANKS, slices, text_bytes, text_hashes

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
SEGMENT_TOKENS = 1 << 20       # a segment is closed by the document that reaches this
CACHE_BYTES = 160 << 20        # of words kept per Python worker, in two generations
CACHED_LENGTH = 64             # code points; longer words are not kept
WORDS = 64                     # new words that are encoded together
TEXT_BYTES = 8 << 20           # of texts whose words are looked up together

#: Blanks that Unicode knows beside the ASCII ones, and bytes one of which each has.
_RARE_BLANK = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029"
                         r"\u202f\u205f\u3000]")
_RARE_BYTES = np.zeros(256, bool)
_RARE_BYTES[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_SINGLE = np.zeros(256, bool)          # blanks that may stand alone between words
_SINGLE[[0x0A, 0x20]] = True
_OTHER = BLANKS & ~_SINGLE


class Recent:
    """Words seen last and their ids, found by hash; equal words decide, not equal hashes.

    ``words[numbers[i]]`` has the hash ``keys[i]``, in ascending order; the ids of word ``n``
    are ``ids[ends[n]:ends[n + 1]]``. Of words with equal hashes the first one is kept.
    """

    def __init__(self):
        self.words = pa.array([], pa.string())
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    @property
    def held(self) -> int:
        """Bytes of all arrays."""
        return sum(x.nbytes for x in (self.words, self.keys, self.numbers, self.ids, self.ends))

    def find(self, words: pa.Array, keys: np.ndarray) -> np.ndarray:
        """Numbers of ``words``, -1 for those not kept."""
        out = np.full(len(words), -1)
        if not len(self.keys):
            return out
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        there = np.flatnonzero(self.keys[at] == keys)
        found = self.numbers[at[there]]
        same = pc.equal(words.take(pa.array(there)), self.words.take(pa.array(found)))
        same = same.to_numpy(zero_copy_only=False)
        out[there[same]] = found[same]
        return out

    def add(self, words: pa.Array, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Keep words that were not found; ``keys`` ascend. Long words are left out."""
        at = np.searchsorted(self.keys, keys)
        keep = pc.less_equal(pc.utf8_length(words), CACHED_LENGTH).to_numpy(zero_copy_only=False)
        if len(self.keys):
            keep &= self.keys[np.minimum(at, len(self.keys) - 1)] != keys
        chosen = np.flatnonzero(keep)
        chosen = chosen[np.diff(keys[chosen], prepend=~keys[chosen[:1]]) != 0]
        ids, sizes = spread(ids, bounds(sizes), chosen)
        self.numbers = np.insert(self.numbers, at[chosen],
                                 len(self.words) + np.arange(len(chosen)))
        self.keys = np.insert(self.keys, at[chosen], keys[chosen])
        self.words = pa.concat_arrays([self.words, words.take(pa.array(chosen))])
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])


class Cache:
    """Words of this generation and of the one before."""

    def __init__(self, always: dict[str, np.ndarray]):
        self.always = always
        self.recent, self.old = self._start(), Recent()

    def _start(self) -> Recent:
        words, out = pa.array(list(self.always), pa.string()), Recent()
        keys = text_hashes(words)
        order = np.argsort(keys)
        out.add(words.take(pa.array(order)), keys[order],
                *joined([list(self.always.values())[i] for i in order.tolist()]))
        return out

    @property
    def new(self) -> list[str]:
        """The words of this generation."""
        return self.recent.words.to_pylist()

    @property
    def held(self) -> int:
        return self.recent.held

    def turn(self, size: int) -> None:
        """Start a generation if this one holds ``size`` bytes."""
        if self.recent.held >= size:
            self.recent, self.old = self._start(), self.recent

    def table(self, words: pa.Array, learn: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different ``words``, and how many each has; ``learn`` tells those of words not
        kept."""
        keys = text_hashes(words)
        order = np.argsort(keys)
        keys, words = keys[order], words.take(pa.array(order))
        number = self.recent.find(words, keys)
        ids, sizes = spread(self.recent.ids, self.recent.ends, number[number >= 0])
        parts, place = [(ids, sizes)], [np.flatnonzero(number >= 0)]
        left = np.flatnonzero(number < 0)
        for known in (self.old, None):
            if not len(left):
                break
            some = words.take(pa.array(left))
            if known:
                number = known.find(some, keys[left])
                hit = np.flatnonzero(number >= 0)
                ids, sizes = spread(known.ids, known.ends, number[hit])
            else:
                hit = np.arange(len(left))
                ids, sizes = learn(some.to_pylist())
            if len(hit):
                self.recent.add(some.take(pa.array(hit)), keys[left[hit]], ids, sizes)
                parts.append((ids, sizes))
                place.append(left[hit])
                left = np.delete(left, hit)
        back = np.empty(len(order), np.int64)
        back[order[np.concatenate(place)]] = np.arange(len(order))
        ids, sizes = (np.concatenate(x) for x in zip(*parts))
        return spread(ids, bounds(sizes), back)


def joined(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Arrays one after the other, and how long each is."""
    return np.concatenate(arrays), np.array([len(a) for a in arrays], np.int64)


def bounds(sizes: np.ndarray) -> np.ndarray:
    """Where each of some runs that follow each other begins, and where the last ends."""
    return np.concatenate([[0], np.cumsum(sizes)])


def spread(ids: np.ndarray, ends: np.ndarray, numbers: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words ``numbers`` one after the other, and how many each has."""
    begin = ends[numbers]
    many = ends[numbers + 1] - begin
    total = np.cumsum(many)
    index = np.repeat(begin - total + many, many)
    index += np.arange(len(index))
    return ids[index], many


class WordTokenizer:
    """A byte-level BPE tokenizer that remembers the ids of words.

    The tokenizer cuts a text before each blank that follows a word, whatever the word, so
    texts whose blanks are single spaces and line breaks are encoded word by word: the distinct
    words of many texts are looked up, and their ids put in place by index. Any other text, and
    one that names a special token, is given to the tokenizer whole.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line, self.space = (np.array(self.tokenizer.encode(c, add_special_tokens=False).ids,
                                          "<u4") for c in "\n ")
        if len(self.line) != 1:
            raise ValueError("a line break has to be one token")
        size = self.tokenizer.get_vocab_size()
        #: Tokens that start with a space, as the first token of a word after a space does.
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120")
                               for i in range(size)])
        #: Words at the start of a line, and words after a space; a space that ends a text and a
        #: line break are words of their own.
        self.first = Cache({"\n": self.line, "": np.zeros(0, "<u4")})
        self.later = Cache({"\n": self.line, "": self.space})

    def _learn(self, words: list[str], spaced: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words, and how many each has. Many are encoded at a time: spaces before
        them, or line breaks between them, tell their ids apart, as no word holds either."""
        parts = [words[at:at + WORDS] for at in range(0, len(words), WORDS)]
        texts = [" " + " ".join(some) if spaced else "\n".join(some) for some in parts]
        every, sizes = [], []
        for some, found in zip(parts, self.tokenizer.encode_batch_fast(
                texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            if spaced:
                many = np.diff(np.flatnonzero(self.opens[ids]), append=len(ids))
            else:
                cut = ids == self.line[0]
                many = np.diff(np.flatnonzero(cut), prepend=-1, append=len(ids)) - 1
                ids = ids[~cut]
            if len(many) != len(some):
                raise ValueError("the tokenizer does not cut at blanks")
            every.append(ids)
            sizes.append(many)
        return np.concatenate(every), np.concatenate(sizes)

    def _whole(self, texts: pa.Array) -> np.ndarray:
        """Which texts have to be encoded whole."""
        data, offsets = text_bytes(texts)
        blank = BLANKS[data]
        bad = _OTHER[data]
        bad[1:] |= blank[1:] & blank[:-1]
        starts = offsets[:-1][offsets[:-1] < len(data)]
        bad[starts] = _OTHER[data[starts]]
        whole = np.zeros(len(texts), bool)
        whole[np.searchsorted(offsets, np.flatnonzero(bad), side="right") - 1] = True
        for i in np.unique(np.searchsorted(offsets, np.flatnonzero(_RARE_BYTES[data]),
                                           side="right") - 1):
            whole[i] = whole[i] or bool(_RARE_BLANK.search(texts[int(i)].as_py()))
        for name in self.special:
            whole |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        return whole

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has."""
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
        ends = words.offsets.to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        code, names = coded.indices.to_numpy(), coded.dictionary.cast(pa.string())
        line = names.index("\n").as_py()
        starts = np.zeros(len(code), bool)
        starts[ends[:-1][ends[:-1] < len(code)]] = True
        starts[1:] |= code[:-1] == line
        # Two words for each name: after a space, and at the start of a line (where it occurs).
        opening = np.zeros(len(names), bool)
        opening[code[starts]] = True
        opening = np.flatnonzero(opening)
        parts = (self.later.table(names, lambda new: self._learn(new, True)),
                 self.first.table(names.take(pa.array(opening)),
                                  lambda new: self._learn(new, False)))
        ids, sizes = (np.concatenate(x) for x in zip(*parts))
        place = np.zeros(len(names), np.int64)
        place[opening] = len(names) + np.arange(len(opening))
        code = np.where(starts, place[code], code)
        ids, many = spread(ids, bounds(sizes), code)
        return ids, np.diff(bounds(many)[ends])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``texts`` one after the other, and how many each has."""
        for known in (self.first, self.later):
            known.turn(CACHE_BYTES // 2)
        whole = self._whole(texts)
        ids, sizes = self._by_words(texts.filter(pa.array(~whole)))
        if not whole.any():
            return ids, sizes
        other = iter([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(
            texts.filter(pa.array(whole)).to_pylist(), add_special_tokens=False)])
        cut = iter(np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else [])
        every = [next(other) if w else next(cut) for w in whole]
        return (np.concatenate([np.zeros(0, np.uint32), *every]),
                np.array([len(e) for e in every], np.int64))


@functools.cache
def _tokenizer(vocabulary: str) -> WordTokenizer:
    return WordTokenizer(vocabulary)


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Small batches put together until they have ``limit`` bytes; larger ones as they are."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > limit:
            some, held, size = pa.concat_batches(held), [], 0
            yield some
            del some
        if batch.nbytes >= limit:
            yield batch
        else:
            held.append(batch)
            size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = VOCABULARY, end_id: int = END_ID,
                 segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Write all documents to ``path``.

    Texts are shuffled once, into ranges of ids; a task holds one segment at a time.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        ids, tokens, sizes, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                 pa.array([start], pa.int64()), pa.array([held], pa.int64()),
                 pa.array([ids], pa.list_(id_type)),
                 pa.array([rans.encode_segment(np.concatenate(tokens), np.concatenate(sizes))],
                          pa.binary())],
                names=["part", "seq", "start", "n_tokens", "ids", "segment"])

        for batch in gathered(batches, TEXT_BYTES):
            id_type = batch.schema.field("id").type
            for piece in slices(batch, "text", TEXT_BYTES):
                found, many = _tokenizer(vocabulary).encode(piece.column("text"))
                found = np.insert(found, np.cumsum(many), end_id)
                many, names, at = many + 1, piece.column("id").to_pylist(), 0
                ends = np.cumsum(many)
                while at < len(many):
                    before = int(ends[at] - many[at])
                    stop = int(np.searchsorted(ends, before + segment_tokens - held)) + 1
                    stop = min(stop, len(many))
                    ids += names[at:stop]
                    tokens.append(found[before:ends[stop - 1]])
                    sizes.append(many[at:stop])
                    held += int(ends[stop - 1]) - before
                    at = stop
                    if held >= segment_tokens:
                        yield segment()
                        seq, start = seq + 1, start + held
                        ids, tokens, sizes, held = [], [], [], 0
        if ids:
            yield segment()

    id_kind = docs.schema["id"].dataType.simpleString()
    (docs.repartitionByRange("id").sortWithinPartitions("id", "text")
     .mapInArrow(run, f"part int, seq int, start long, n_tokens long, ids array<{id_kind}>, "
                      "segment binary")
     .write.option("compression", "uncompressed").parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``id, start, n_tokens, ids_crc32, tokens`` of every document; ``tokens`` are
    little-endian unsigned 32-bit numbers, ``start`` counts the tokens of all documents before."""
    stored = spark.read.parquet(path)
    id_type = stored.schema["ids"].dataType.elementType.simpleString()
    # One row per part, that is per task that wrote.
    totals = sorted(stored.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before, bases = 0, []
    for row in totals:
        bases.append((row.part, before))
        before += row.n
    bases = spark.createDataFrame(bases, "part int, base long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = rans.Segment.open(batch.column("segment")[i].as_py()).documents()
                sizes = np.array([len(t) for t in found], np.int64)
                start = batch.column("start")[i].as_py() + batch.column("base")[i].as_py()
                coded = [t.astype("<u4").tobytes() for t in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, pa.array(start + np.cumsum(sizes) - sizes),
                     pa.array(sizes), pa.array([zlib.crc32(t) for t in coded], pa.int64()),
                     pa.array(coded, pa.binary())],
                    names=["id", "start", "n_tokens", "ids_crc32", "tokens"])

    return (stored.join(F.broadcast(bases), "part").select("start", "base", "ids", "segment")
            .mapInArrow(run, f"id {id_type}, start long, n_tokens long, ids_crc32 long, "
                             "tokens binary"))

"""Byte-level BPE against the rank files' own library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import ODD_ROWS

from civiltext.llm import byte_bpe, queries

OTHERS = [" ", "\n\n \n", "it's we'll I'd 'S", "a  b   c ", " 12 345a6", "x\u0085y z　 w",
          "ẞ\U0001f600‍", "́á", "각\U00018d8c붜 \U00012480a",
          "<|endoftext|><unk>", "ab" * 300, "a.b.c" * 50, "\x1c \x1d", "﻿▁ ▁"]


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=byte_bpe.read_ranks(byte_bpe.VOCABULARY))


def random_texts(n):
    rng = random.Random(7)
    kinds = [range(32, 127), range(0xA0, 0x250), range(0x370, 0xD7FF), range(0x10000, 0x1F900)]
    return ["".join(chr(rng.choice(rng.choice(kinds))) for _ in range(rng.randrange(60)))
            for _ in range(n)] + ["".join(rng.choice(" \n\tab1.'s") for _ in range(rng.randrange(40)))
                                  for _ in range(n)]


def check(coder, texts, plain):
    ids, sizes = coder.encode(texts)
    got = np.split(np.frombuffer(ids, "<u4"), np.cumsum(sizes)[:-1])
    for text, own in zip(texts, got, strict=True):
        assert own.tolist() == plain.encode_ordinary(text), repr(text)
    data, ends = coder.decode(np.frombuffer(ids, "<u4"), sizes)
    assert [bytes(data[a:b]).decode() for a, b in zip(ends[:-1], ends[1:])] == texts


def test_same_ids_as_the_ranks(tables, plain):
    coder = byte_bpe.ByteCodec(byte_bpe.VOCABULARY)
    check(coder, OTHERS + random_texts(1500) + [t for _, t in ODD_ROWS if t], plain)
    check(coder, [r.text or "" for r in tables("documents").collect()], plain)
    check(coder, [t.decode("utf-8", "ignore") for t in coder.ranks], plain)


def test_other_vocabulary():
    name = "byte_bpe_50k.tiktoken"
    other = tiktoken.Encoding("other", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=byte_bpe.read_ranks(name))
    check(byte_bpe.ByteCodec(name), OTHERS + random_texts(200), other)


def test_long_texts_are_cut_and_the_cache_is_bounded(plain, monkeypatch):
    monkeypatch.setattr(byte_bpe, "STRETCH", 40)
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 20_000)
    coder = byte_bpe.ByteCodec(byte_bpe.VOCABULARY)
    texts = random_texts(300)
    check(coder, [*texts, " ".join(texts), "\n".join(texts[::-1]), "漢" * 5000], plain)
    assert coder.known_bytes < 40_000
    assert max(map(len, coder.known)) <= byte_bpe.CACHED_LENGTH


def test_pre_tokens_match_over_all_code_points(plain):
    cutter = byte_bpe.codec().cutter
    single = tiktoken.Encoding("b", pat_str=public_tokenizers.PATTERN, special_tokens={},
                               mergeable_ranks={bytes([b]): b for b in range(256)})
    for kind in byte_bpe.CLASSES:
        points = byte_bpe.members(kind)
        assert byte_bpe.re.findall(f"[{byte_bpe.ranges(points)}]", byte_bpe._every()) \
            == [chr(p) for p in points]
    for at in range(0x100, 0x34000, 0x100):
        text = "a".join(chr(c) for c in range(at, at + 0x100) if not 0xD800 <= c < 0xE000)
        assert sum(len(w.encode()) for w in cutter.cut(text)) == len(single.encode_ordinary(text))
        assert "".join(cutter.cut(text)) == text


def test_ranks_must_be_complete():
    with pytest.raises(ValueError):
        byte_bpe.model_bytes({b"a": 0})
    with pytest.raises(ValueError):
        byte_bpe.model_bytes({bytes([b]): b + 1 for b in range(256)})


def test_rows_of_all_kinds(spark, frame, odd, plain):
    want = {(i, t or "") for i, t in ODD_ROWS}
    coded = byte_bpe.encode(odd)
    assert coded.columns == ["id", "ids"]
    back = byte_bpe.decode(coded).collect()
    assert len(back) == len(ODD_ROWS) and {(r.id, r.text) for r in back} == want
    assert all(r.text.encode() == r.bytes for r in back)
    rows = byte_bpe.round_trip(odd).collect()
    digests = {(i, len(ids := plain.encode_ordinary(t)),
                hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(t.encode()).hexdigest()) for i, t in want}
    assert len(rows) == len(ODD_ROWS) and {tuple(r) for r in rows} == digests
    assert byte_bpe.round_trip(frame([])).count() == byte_bpe.encode(frame([])).count() == 0
    odd_ids = spark.createDataFrame([(1, None), (2, [None, -1, 10**6, 64]), (3, [])],
                                    "id long, ids array<int>")
    one = plain.decode_bytes([64]).decode()
    assert {tuple(r) for r in byte_bpe.decode(odd_ids).select("id", "text").collect()} \
        == {(1, ""), (2, one), (3, "")}


def test_query(spark, plain):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in queries.op11_byte_bpe(spark, sf).collect()}
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = plain.encode_ordinary(row.text or "")
        assert got[row.doc_id] == (len(ids),
                                   hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())

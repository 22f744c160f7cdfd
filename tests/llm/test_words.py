"""Words, their hashes and runs."""

import brute
import numpy as np
import pyarrow as pa

from civiltext.llm import bloom, words as w


def test_words_match_plain_version(tables, monkeypatch):
    texts = [r.text for r in tables("documents").limit(40).collect()] + ["", " ", "x", "É\tx\x0by "]
    found = w.find_words(pa.array(texts))
    data = found.data.tobytes()
    for i, text in enumerate(texts):
        a, b = found.first[i], found.first[i + 1]
        spans = zip(found.starts[a:b], found.ends[a:b])
        assert [data[s:e].decode() for s, e in spans] == brute.WORD.findall(text)
    plain = [x for t in texts for x in brute.WORD.findall(brute.lower(t))]
    assert len(set(zip(plain, found.hashes.tolist()))) == len(set(plain)) \
        == len(set(found.hashes.tolist()))
    monkeypatch.setattr(w, "HASH_BYTES", 50)
    assert (w.find_words(pa.array(texts)).hashes == found.hashes).all()


def test_pieces_cover_all_rows():
    texts = pa.array(["a" * n for n in (0, 5, 3000, 1, 2000, 0, 10, 10)])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    pieces = list(w.slices(batch, "text", 1000))
    assert [x for p in pieces for x in p.column(0).to_pylist()] == texts.to_pylist()
    assert all(p.num_rows == 1 or sum(map(len, p.column(0).to_pylist())) <= 1000 for p in pieces)


def test_bloom_holds_what_it_was_given(spark):
    df = spark.range(5000).selectExpr("id * 7919 - 20000000 AS k").union(
        spark.sql("SELECT CAST(NULL AS long)"))
    keys = np.arange(5000) * 7919 - 20_000_000
    for bits, wrong in ((16, 1.0), (23, 0.01)):
        filter_ = bloom.build(df, "k", bits)
        assert filter_.holds(keys.astype(np.int64)).all()
        assert filter_.holds(np.arange(10**9, 10**9 + 10_000)).mean() <= wrong
    assert not bloom.build(df.limit(0), "k").holds(keys).any()

"""Codes of n-grams, the counting filter and counts by it, against plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from civiltext.operators import features as ft, sketch
from civiltext.operators import termcodes as tc
from civiltext.operators.sums import summed


def plain_grams(text, ngrams):
    words = text.split(" ") if text else []
    return [" ".join(words[i:i + n]) for n in range(ngrams[0], ngrams[1] + 1)
            for i in range(len(words) - n + 1)]


def some_texts(n, seed=1, words=40):
    rng = random.Random(seed)
    known = ["".join(rng.choice("abcé漢") for _ in range(rng.randrange(2, 6))) for _ in range(words)]
    return ["", "aa", "x" * 5000] + [" ".join(rng.choices(known, k=rng.randrange(30)))
                                     for _ in range(n)]


@pytest.mark.parametrize("ngrams", [(1, 1), (1, 2), (2, 3), (1, 4)])
def test_grams_are_stretches_of_the_text(ngrams):
    texts = some_texts(200)
    found = tc.grams(pa.array(texts[:1] + [None] + texts[1:]), ngrams)
    strings = found.strings(np.arange(len(found.row))).to_pylist()
    want = Counter((i + (i > 0), g) for i, t in enumerate(texts) for g in plain_grams(t, ngrams))
    assert Counter(zip(found.row.tolist(), strings)) == want
    by_code = dict(zip(found.code.tolist(), strings))
    assert len(by_code) == len(set(strings))
    terms = sorted(set(strings))
    assert [by_code[c] for c in tc.codes_of(terms).tolist()] == terms


def test_no_texts_have_no_grams():
    for texts in ([], ["", None]):
        found = tc.grams(pa.array(texts, pa.string()), (1, 2))
        assert len(found.code) == 0 and len(found.strings(np.arange(0))) == 0


def test_pieces_cover_all_texts(monkeypatch):
    monkeypatch.setattr(tc, "PIECE_BYTES", 100)
    texts = some_texts(50)
    assert [t for p in tc.pieces(pa.array(texts)) for t in p.to_pylist()] == texts


@pytest.mark.parametrize("least", [1, 2, 3, 300])
def test_packed_counts_come_back(least):
    counts = np.random.default_rng(3).integers(0, least + 1, 1 << 12).astype(np.min_scalar_type(least))
    assert (sketch._unpacked(sketch._packed(counts, least), least) == counts).all()


def test_filter_lets_no_frequent_key_go(spark):
    texts = some_texts(600, words=900)
    df = spark.createDataFrame([(t,) for t in texts], "tokens string").repartition(5)
    want = Counter(t for text in texts for t in set(plain_grams(text, (1, 2))))
    cells = 1 << 14

    def coded(batches):
        for batch in batches:
            found = tc.grams(batch.column(0), (1, 2))
            yield found.row, found.code

    counted = df.mapInArrow(lambda b: sketch.count_rows(coded(b), 3, cells), sketch.COUNTED)
    bits = sketch.reached(counted, 3, cells)
    terms = sorted(want)
    passes = sketch.may_reach(bits, tc.codes_of(terms))
    assert all(p for t, p in zip(terms, passes) if want[t] >= 3)
    assert sum(passes) < sum(n >= 3 for n in want.values()) + len(terms) / 4
    with pytest.raises(ValueError):
        list(sketch.count_rows([], 3, 3000))


@pytest.mark.parametrize("min_df, cells", [(1, 1 << 12), (2, 1 << 12), (3, 1 << 11), (3, 1 << 20)])
def test_counts_are_exact(spark, min_df, cells):
    texts = some_texts(400, words=300) + ["twice twice", None]
    df = spark.createDataFrame([(t,) for t in texts], "tokens string").repartition(4)
    tf = Counter(g for t in texts for g in plain_grams(t or "", (1, 2)))
    rows = Counter(g for t in texts for g in set(plain_grams(t or "", (1, 2))))
    got = {tuple(r) for r in ft.frequent_counts(df, "tokens", (1, 2), min_df, cells).collect()}
    assert got == {(t, tf[t], n) for t, n in rows.items() if n >= min_df}


def test_sums_over_tasks(spark):
    df = spark.range(1000).repartition(7)

    def squares(batches):
        out = np.zeros((3, 50_000))
        for batch in batches:
            ids = batch.column(0).to_numpy()
            out[1, ids] += ids
            out[2, -1] += len(ids)
        return out

    total = summed(df, squares, (3, 50_000))
    assert (total[1, :1000] == np.arange(1000)).all() and total[2, -1] == 1000
    assert total[0].sum() == 0 and zlib.crc32(total[1, 1000:].tobytes()) == zlib.crc32(bytes(8 * 49_000))

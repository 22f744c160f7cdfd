"""Ranked search against a plain version that scores every pair."""

import math
import re
from collections import Counter

import pyarrow as pa
import pytest
from conftest import ODD_ROWS

from civiltext.llm import lexical_search, queries


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(lexical_search.TERM, low)


def plain_search(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    seen = sum(bool(bag) for _, bag in bags)
    total = sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    rows = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            m = 25 + (75 * sum(bag.values()) * seen) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * seen + 2) / (2 * df[t] + 1)))
                        * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                        for t in terms(text) if t in bag)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, rank, doc_id, -s)
                 for rank, (s, _, _, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=str)


def found(*args, **options):
    return sorted((tuple(r) for r in lexical_search.search(*args, **options).collect()), key=str)


@pytest.fixture(scope="module")
def some(tables):
    docs = [(r.doc_id, r.text) for r in tables("documents").collect()] + ODD_ROWS
    items = [(r.item_id, r.text) for r in tables("benchmark").collect()][:12]
    # Items without terms, repeated, without id, with a term of many documents, with odd signs.
    items += [(900, None), (901, " .,;"), items[0], (None, items[1][1]), (902, "word Word WORD four"),
              (903, "é ü 漢字 ▁ \U0001f600 endoftext"), (904, items[2][1] + " " + items[3][1])]
    return docs, items


def asked(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr(
        "item_id", "text", "1 AS key", "'x' AS terms", "2 AS score")


@pytest.mark.parametrize("options", [{}, {"k": 3, "block_bytes": 300}, {"k": 10**4}])
def test_same_as_scoring_every_pair(spark, frame, some, options):
    docs, items = some
    got = found(frame(docs), asked(spark, items), **options)
    assert got == plain_search(docs, items, options.get("k", 10))


def test_small_portions(spark, frame, some, monkeypatch):
    """The limits on what is held at once change nothing."""
    docs, items = some
    texts, n = pa.array([t or "" for _, t in docs]), 40
    block = lexical_search.Block.of([(str(i), terms(t)) for i, t in items])
    whole = lexical_search._scan(block.automaton(), texts, len(block.terms))
    monkeypatch.setattr(lexical_search, "MATCHES", 7)
    parts = lexical_search._scan(block.automaton(), texts, len(block.terms))
    assert all((a == b).all() for a, b in zip(whole, parts))
    weight = lexical_search.np.arange(1, len(block.terms) + 1)
    m = lexical_search.np.arange(len(docs)) + 25
    args = (block, weight, m, *whole)
    scores = lexical_search._scores(*args)
    monkeypatch.setattr(lexical_search, "CELLS", 3)
    assert (lexical_search._scores(*args) == scores).all()
    monkeypatch.setattr(lexical_search, "HELD", 1)
    for step in (1, n):
        best = lexical_search._Best(len(items), 2, pa.int64())
        for at in range(0, len(docs), step):
            best.add(scores[at:at + step], pa.array([i for i, _ in docs[at:at + step]], pa.int64()))
        kept = best.reduce().to_pylist()
        for item in range(len(items)):
            want = sorted((-s, i is None, i or 0) for s, (i, _) in zip(scores[:, item], docs) if s)[:2]
            assert [-r["score"] for r in kept if r["item"] == item] == [w[0] for w in want]
            assert [r["id"] or 0 for r in kept if r["item"] == item] == [w[2] for w in want]


def test_sizes_of_texts(some):
    texts = [t or "" for _, t in some[0]] + ["", "a", " a", "a ", "é\x00b"]
    assert lexical_search._sizes(pa.array(texts)).tolist() == [len(terms(t)) for t in texts]
    assert lexical_search._sizes(pa.array([], pa.string())).tolist() == []


def test_copies_and_ties(spark, frame):
    docs = [(i, "alpha beta gamma") for i in range(50, 0, -1)] + [(99, "alpha delta")] * 2
    items = [(1, "alpha"), (2, "delta alpha alpha"), (3, "nothing")]
    assert found(frame(docs), asked(spark, items)) == plain_search(docs, items)


def test_empty_tables(spark, frame, some):
    docs, items = some
    assert found(frame([]), asked(spark, items)) == []
    assert found(frame(docs), asked(spark, [])) == []
    assert found(frame([(1, None), (2, "")]), asked(spark, items)) == []


def test_query(spark, tables):
    sf = "/root/testdata/sf0.001"
    got = sorted((tuple(r) for r in queries.op13_lexical_search(spark, sf).collect()), key=str)
    assert got == plain_search([(r.doc_id, r.text) for r in tables("documents").collect()],
                               [(r.item_id, r.text) for r in tables("benchmark").collect()])

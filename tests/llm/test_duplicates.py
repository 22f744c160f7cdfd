"""Similarity join, sentence spans and components against plain versions."""

import random
from fractions import Fraction

import brute
import numpy as np
import pytest
from conftest import ODD_ROWS
from pyspark.sql import functions as F

from civiltext.llm import components, jaccard_join, queries, sentence_spans
from civiltext.llm.jaccard_join import PrefixTree, similar


def near_copies(seed, groups=12, size=9):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.choice([4, 30, 60, 120]))
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("n, threshold, block", [(3, "0.9", None), (5, "0.8", None),
                                                  (2, "0.5", 300), (1, "1", None)])
def test_join_matches_all_pairs(frame, n, threshold, block):
    rows = near_copies(n) + [(1000 + i, f"shared start of text number {i}") for i in range(30)]
    options = {"block_runs": block} if block else {}
    got = jaccard_join.jaccard_components(frame(rows), n=n, threshold=threshold, **options)
    got = sorted(got.select("id", "n_shingles", "component_id").collect())
    assert [tuple(r) for r in got] == sorted(brute.jaccard_components(rows, n, threshold))


def test_join_of_documents(tables):
    docs = tables("documents").select("doc_id", "text")
    got = jaccard_join.jaccard_components(docs, n=5, threshold="0.8")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(tuple(r) for r in got.select("id", "n_shingles", "component_id").collect()) \
        == sorted(brute.jaccard_components(rows, 5, "0.8"))


def test_join_of_odd_rows(odd, frame):
    got = jaccard_join.jaccard_components(odd, n=3, threshold="0.9")
    order = lambda rows: sorted(map(str, rows))
    assert order(tuple(r) for r in got.select("id", "n_shingles", "component_id").collect()) \
        == order(brute.jaccard_components(ODD_ROWS, 3, "0.9"))
    assert jaccard_join.jaccard_components(frame([])).collect() == []


def test_prefix_tree_finds_every_similar_set():
    rng = random.Random(5)
    sets = []
    for _ in range(40):
        base = rng.sample(range(300), rng.randrange(1, 60))
        for _ in range(5):
            sets.append(np.array(sorted({x if rng.random() > 0.1 else rng.randrange(300)
                                         for x in base}), np.uint64))
    tree = PrefixTree.build(sets)
    for threshold in (Fraction(1, 2), Fraction(4, 5), Fraction(9, 10), Fraction(1)):
        for s in sets:
            expected = {i for i, t in enumerate(sets)
                        if len(set(s) & set(t)) >= threshold * len(set(s) | set(t))}
            assert set(tree.search(s, threshold, lambda i: False)) == expected
            assert {i for i, t in enumerate(sets) if similar(s, t, threshold)} == expected


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(10, 60)] + [(5, 5)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = dict(got)
    assert len(got) == len(roots) == 41 + 51
    assert {roots[i] for i in range(100, 141)} == {100}
    assert {roots[i] for i in range(10, 60)} == {7}


def test_spans_match_plain_version(tables, frame):
    rows = [tuple(r) for r in tables("documents").select("doc_id", "text").collect()]
    got = sentence_spans.remove_repeated_spans(frame(rows))
    expected = brute.removed_sentences(rows, sentence_spans.MIN_SENTENCES,
                                       sentence_spans.MIN_WORDS)
    assert {r.id: r.n_removed for r in got.collect()} == expected
    assert sum(expected.values()) > 0


def test_repeated_passage_goes_from_later_documents(frame):
    passage = " ".join(f"Sentence number {i} of a passage that stands in many places." for i in
                       range(6))
    rows = [(3, f"Own start here. {passage} Own end three."), (1, passage),
            (2, f"Something else first.\n{passage}\nAnd after it."), (9, "Untouched words.")]
    got = {r.id: r for r in sentence_spans.remove_repeated_spans(frame(rows)).collect()}
    assert got[1].text == passage and got[1].n_removed == 0
    assert got[2].text == "Something else first.\nAnd after it." and got[2].n_removed == 6
    assert got[3].text == "Own start here. Own end three."
    assert got[9].text == "Untouched words."


def test_spans_of_odd_rows(odd, frame):
    got = sentence_spans.remove_repeated_spans(odd)
    assert got.count() == len(ODD_ROWS)
    texts = {(r.id, r.text) for r in got.filter(F.col("n_removed") == 0).collect()}
    assert (1, "") in texts and (4, "other words under this id") in texts
    assert sentence_spans.remove_repeated_spans(frame([])).collect() == []


def test_long_sentences_and_texts_of_one_sentence_are_runs(frame):
    long = " ".join(f"word{i}" for i in range(59)) + " end."
    single = "a text without any mark that is one sentence of more than twelve words"
    rows = [(1, f"First. {long} Then."), (2, f"Other start. {long} Other end."), (3, long),
            (4, single), (5, single), (6, "Short one."), (7, "Short one.")]
    got = {r.id: r for r in sentence_spans.remove_repeated_spans(frame(rows)).collect()}
    assert got[1].text == rows[0][1] and got[4].text == single
    assert got[2].text == "Other start. Other end." and got[2].words_removed == 60
    assert got[3].text == got[5].text == "" and got[5].n_removed == 1
    assert got[6].text == got[7].text == "Short one."


def span_rows():
    """Texts in which every rule acts: short runs, long sentences, one-sentence texts, marks."""
    rng = random.Random(5)
    ends = [*".!?", "।", "。", "…", ".”", "?»", "\n", ""]
    known = [" ".join(f"w{rng.randrange(30)}" for _ in range(n)) + rng.choice(ends)
             for n in [3, 5, 8, 12, 20, 49, 50, 51, 80] * 3]
    rows = [(i, " ".join(rng.choices(known, k=rng.choice([1, 1, 2, 3, 5])))) for i in range(120)]
    return rows + [(200, ""), (201, None), (202, "."), (203, known[8]), (204, known[8])]


def test_spans_match_plain_version_where_all_rules_act(frame):
    rows = span_rows()
    got = sentence_spans.remove_repeated_spans(frame(rows))
    expected = brute.removed_sentences(rows, sentence_spans.MIN_SENTENCES, sentence_spans.MIN_WORDS)
    assert {r.id: r.n_removed for r in got.collect()} == expected
    assert sum(n > 0 for n in expected.values()) > 50


def test_sql_where_all_rules_act(frame, tmp_path):
    import duckdb
    rows = span_rows()
    frame(rows, extra=False).write.parquet(f"{tmp_path}/documents")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    cursor = con.execute(queries.SQL["op10_sentence_spans"])
    names = [c[0] for c in cursor.description]
    want = {r["doc_id"]: r for r in (dict(zip(names, row)) for row in cursor.fetchall())}
    got = sentence_spans.remove_repeated_spans(frame(rows)).collect()
    assert len(got) == len(want)
    for r in got:
        assert {"doc_id": r.id, "text": r.text, "n_removed": r.n_removed,
                "words_removed": r.words_removed} == want[r.id]


def test_rows_without_ids_whose_hashes_meet(frame, monkeypatch):
    """Rows with equal 64-bit keys are still told apart; each loses its own sentences only."""
    keys = sentence_spans._keys()
    monkeypatch.setattr(sentence_spans, "_keys", lambda: {**keys, "key": F.lit(7).cast("long")})
    passage = " ".join(f"Sentence number {i} of a passage that stands twice." for i in range(4))
    rows = [(None, passage), (None, f"Alone here. {passage}"), (None, "One. Two. Three. Four."),
            (None, " ".join(f"Other words number {i} that nobody repeats." for i in range(9)))]
    got = sorted((r.n_removed, r.text) for r in
                 sentence_spans.remove_repeated_spans(frame(rows)).collect())
    assert [n for n, _ in got] == [0, 0, 0, 4]
    assert {t for n, t in got if n == 0} >= {rows[2][1], rows[3][1]}


def test_sentence_marks_of_other_scripts(frame):
    for mark in ("।", "۔", "؟", "。", "！", "…", "።", ".”", "?»"):
        passage = " ".join(f"w{i} x y z u v{mark}" for i in range(4))
        rows = [(1, f"a b{mark} {passage} c d{mark}"), (2, f"e f{mark} {passage} g h{mark}")]
        got = {r.id: r for r in sentence_spans.remove_repeated_spans(frame(rows)).collect()}
        assert got[1].n_removed == 0 and got[2].n_removed == 4, mark
        assert got[2].text == f"e f{mark} g h{mark}"

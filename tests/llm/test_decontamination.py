"""Greedy string tiling against a plain version."""

import random

import brute
import numpy as np
from conftest import ODD_ROWS

from civiltext.llm import decontamination as d


def test_tiles_match_plain_version():
    rng = random.Random(3)
    for _ in range(60):
        item = [rng.randrange(1, 6) for _ in range(rng.randrange(0, 30))]
        doc = [rng.randrange(0, 6) for _ in range(rng.randrange(0, 40))]
        if rng.random() < 0.5 and len(item) > 8:
            doc[3:3] = item[5:] + item[:5]
        got = d.greedy_tiles(np.array(item, np.uint64), np.array(doc, np.uint64), 3)
        assert got == brute.tiles(item, doc, 3)


def test_moved_sentences_are_caught(frame, spark):
    first = "the quick brown fox jumps over the lazy dog near a river"
    second = "while seven grey cats watch from under an old wooden bridge"
    items = spark.createDataFrame([(10, f"{first}. {second}."), (11, "too short"), (12, None),
                                   (10, f"{first}. {second}.")], "item_id long, text string")
    rows = [(1, f"Some words. {second.upper()}! More of them, then {first}? The end."),
            (2, f"Only half of it: {first}, and much more text of its own."),
            (3, "Nothing of the sort is written in this document at all."), (4, first[:40])]
    got = {(r.id, r.item_id): r for r in d.contaminations(frame(rows), items).collect()}
    assert set(got) == {(1, 10), (2, 10)}, got
    assert got[1, 10].coverage == 1 and got[1, 10].tiles == 2
    assert got[2, 10].matched == 12
    kept = d.drop_contaminated(frame(rows), items)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4]
    assert kept.columns == frame(rows).columns


def test_documents_match_plain_version(tables):
    docs, items = tables("documents"), tables("benchmark")
    got = {(r.id, r.item_id): r.matched for r in d.contaminations(docs, items).collect()}

    def words(text):
        return "".join(c if c.isalnum() or ord(c) > 127 else " "
                       for c in brute.lower(text)).split()

    expected = {}
    grams = {}
    for r in items.collect():
        w = words(r.text)
        grams[r.item_id] = (w, {tuple(w[i:i + 4]) for i in range(len(w) - 3)})
    for r in docs.collect():
        w = words(r.text)
        mine = {tuple(w[i:i + 4]) for i in range(len(w) - 3)}
        for item, (tokens, seeds) in grams.items():
            if seeds & mine:
                matched = sum(t[2] for t in brute.tiles(tokens, w, 4))
                if matched >= (d.THRESHOLD * len(tokens) if len(tokens) >= 9 else len(tokens)):
                    expected[r.doc_id, item] = matched
    assert got == expected and expected


def test_odd_rows(odd, frame, tables, spark):
    assert d.drop_contaminated(odd, tables("benchmark")).count() == len(ODD_ROWS)
    items = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    hits = sorted((r.id is not None, r.id) for r in d.contaminations(odd, items).collect())
    assert hits == [(False, None), (True, 4), (True, 9)]
    assert d.contaminations(frame([]), items).collect() == []
    assert d.contaminations(odd, items.limit(0)).collect() == []


def plain(rows, items, k=4):
    """Every pair, by trying everything."""
    def words(text):
        return "".join(c if c.isalnum() or ord(c) > 127 else " "
                       for c in brute.lower(text or "")).split()

    out = {}
    for item_id, text in items:
        item = words(text)
        for doc_id, doc in rows:
            doc = words(doc)
            if len(item) < k:
                n = len(item)
                if n and any(doc[i:i + n] == item for i in range(len(doc) - n + 1)):
                    out[doc_id, item_id] = n
            else:
                matched = sum(t[2] for t in brute.tiles(item, doc, k))
                if matched >= (len(item) if len(item) < 9 else 0.5 * len(item)):
                    out[doc_id, item_id] = matched
    return out


def test_random_items_of_all_lengths(frame, spark):
    rng = random.Random(17)
    words = [f"w{i}" for i in range(14)]
    opening = "which of the following statements holds"
    items = [(i, " ".join([opening] * (i % 3 == 0) + rng.choices(words, k=rng.randrange(0, 18))))
             for i in range(60)]
    rows = []
    for i in range(60):
        parts = [rng.choice(items)[1].split() for _ in range(rng.randrange(3))]
        cut = [p[rng.randrange(len(p) // 2 + 1):] for p in parts]
        rows.append((i, " ".join([opening] * (i % 4 == 0) + rng.choices(words, k=6)
                                 + [w for p in cut for w in p])))
    found = d.contaminations(frame(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.id, r.item_id): r.matched for r in found.collect()} == plain(rows, items)


def test_short_items_and_common_phrases(frame, spark):
    items = spark.createDataFrame(
        [(1, "Quetzal"), (2, "blue moon"), (3, "a red fox"), (4, "which of the following statements"),
         (5, "which of the following statements about rain is")], "item_id long, text string")
    rows = [(1, "The quetzal sings."), (2, "A blue, blue moon: a red fox"), (3, "a blue red moon fox"),
            (4, "Say which of the following is true"),
            (5, "which of the following statements, then")]
    found = d.contaminations(frame(rows), items).collect()
    assert {(r.id, r.item_id, r.coverage) for r in found} == {
        (1, 1, 1.0), (2, 2, 1.0), (2, 3, 1.0), (5, 4, 1.0)}
    kept = d.drop_contaminated(frame(rows), items)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4]


def test_common_opening_makes_no_pairs(frame, spark):
    opening = "which of the following statements is"
    items = spark.createDataFrame([(i, f"{opening} " + " ".join(f"i{i}x{j}" for j in range(12)))
                                   for i in range(1500)], "item_id long, text string")
    rows = [(i, f"{opening} " + " ".join(f"d{i}x{j}" for j in range(12))) for i in range(1500)]
    rows.append((9999, f"and {opening} " + " ".join(f"i7x{j}" for j in range(12))))
    found = d.contaminations(frame(rows), items).collect()
    assert [(r.id, r.item_id, r.coverage) for r in found] == [(9999, 7, 1.0)]
    tokens = np.arange(1, 19, dtype=np.uint64)
    seeds = d.karp_rabin(tokens, 4)
    kept = d._to_join(tokens, seeds, 9, 4)
    assert len(kept) < len(seeds) and not set(seeds[:5].tolist()) & set(kept.tolist())

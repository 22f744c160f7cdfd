"""Spelling variants against a plain version over all pairs."""

import random
import zlib
from collections import Counter

import pytest
from conftest import ODD_ROWS

from civiltext.llm import queries, spelling


def one_edit(a, b):
    """Whether exactly one code point inserted, deleted or replaced turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_near(counts):
    found = {}
    for word, n in counts.items():
        near = sorted((-m, other) for other, m in counts.items() if one_edit(word, other))
        best = (near[0][1], -near[0][0]) if near else (None, None)
        found[word] = (n, len(near), *best)
    return found


def plain_words(rows, damage, min_length=6, min_count=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in spelling.re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def plain_groups(counts, ratio=5):
    near = plain_near(counts)
    form = {w: b if b is not None and m >= ratio * n else None for w, (n, _, b, m) in near.items()}
    rows = set()
    for word, (n, k, _, m) in near.items():
        root = word
        while form[root] is not None:
            root = form[root]
        rows.add((word, form[word], root, n, k, m if form[word] is not None else None))
    return rows


def some_words(n, seed, letters="abé", sizes=(6, 11)):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randrange(*sizes))): rng.randrange(5, 400)
            for _ in range(n)}


@pytest.mark.parametrize("letters, sizes", [("ab", (1, 9)), ("abé", (6, 11)), ("xyz", (6, 8))])
def test_sorted_list_finds_all(letters, sizes):
    words = sorted(some_words(400, 3, letters, sizes))
    known = spelling.SortedList(words)
    for word in words:
        for kept in range(len(word) + 1):
            got = [words[i] for i in known.near(word, kept)]
            assert got == [u for u in words if one_edit(word, u) and u[:kept] == word[:kept]]


@pytest.mark.parametrize("letters, sizes", [("ab", (1, 7)), ("abcx", (3, 6))])
def test_no_block_with_a_near_word_is_left_out(letters, sizes):
    words = sorted(some_words(250, 4, letters, sizes))
    for step in (1, 3, 20):
        cuts = spelling.Blocks(words[step::step])
        for word in words:
            for kept in range(len(word) + 1):
                near = {cuts.of(u) for u in words if one_edit(word, u) and u[:kept] == word[:kept]}
                assert near <= set(cuts.to_search(word, kept))


@pytest.mark.parametrize("block_words", [7, 50, 100_000])
def test_near_words_over_blocks(spark, block_words):
    counts = some_words(600, 5) | some_words(200, 6, "abcdefgh") | {"a": 5, "b": 9, "x" * 5000: 7}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r[0]: tuple(r[1:]) for r in spelling.near_words(words, block_words).collect()}
    assert got == plain_near(counts)


def test_hot_beginning_is_spread(spark):
    """Many words with one beginning: each looks into few blocks."""
    words = sorted(some_words(4000, 8, "abcdefghijklm", (6, 7)))
    words = ["con" + w for w in words]
    cuts = spelling.Blocks(words[20::20])
    looked = [len(list(cuts.to_search(w, 3))) for w in words]
    assert len(cuts.ends) == 200 and max(looked) < 60


def test_groups_of_documents(spark, frame):
    rng = random.Random(9)
    words = list(some_words(60, 10, "abc"))
    rows = [(i, " ".join(rng.choices(words, weights=[2**(j % 12) for j in range(len(words))], k=40))
             + rng.choice(["-", ". ", "\n"]) + rng.choice(words).upper()) for i in range(150)]
    rows += [r for r in ODD_ROWS for _ in range(5)]
    rows.append((500, "ketteab " * 5 + "kettea " * 30 + "kettee " * 200 + "kettex " * 200))
    for damage in (None, 7):
        got = spelling.group_variants(frame(rows), damage=damage, block_words=10)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        found = got.collect()
        want = plain_groups(plain_words(rows, damage))
        assert {tuple(r) for r in found} == want and len(found) == len(want)
    assert any(r[2] not in (r[0], r[1]) for r in want)


def test_no_words(spark, frame):
    for rows in ([], [(1, None), (2, ""), (None, "one two")]):
        assert spelling.group_variants(frame(rows)).collect() == []


def test_damaged_runs_that_become_each_other():
    """A run that loses a code point may become another run of the text that loses one too."""
    text = "aaaaaaaaa " * 3 + "aaaaaaaa " * 5 + "aaaaaaa"
    assert spelling.text_words(text, 1, 6, 1) == {"a" * 8: 3, "a" * 7: 5, "a" * 6: 1}
    rng = random.Random(12)
    for doc_id in range(50):
        text = " ".join("".join(rng.choice("abÉ") for _ in range(rng.randrange(6, 9))) for _ in range(400))
        got = spelling.text_words(text, doc_id, 6, 3)
        assert {w: n for w, n in got.items() if len(w) >= 6} == plain_words([(doc_id, text)], 3, 6, 1)


def test_blocks_of_words_with_one_long_beginning(spark):
    """Where words are cut apart by sampled beginnings that are alike, blocks are fewer."""
    counts = {"x" * 300 + a + b: 5 + i for i, a in enumerate("abcdefgh") for b in "abcdefgh"}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r[0]: tuple(r[1:]) for r in spelling.near_words(words, 5).collect()}
    assert got == plain_near(counts)


def test_texts_in_parts(monkeypatch):
    text = "Wörter " + "immer " * 50 + "x" * 500 + "-Ende"
    whole = spelling.text_words(text, 3, 1, 2)
    monkeypatch.setattr(spelling, "STRETCH", 10)
    assert spelling.text_words(text, 3, 1, 2) == whole
    assert list(spelling._stretches("")) == [""]


def test_tasks_hand_on_what_they_hold(spark, frame, monkeypatch):
    rows = [(i, f"gleiche woerter nummer{chr(97 + i % 26)}abc") for i in range(300)]
    want = plain_words(rows, None)
    monkeypatch.setattr(spelling, "HELD_BYTES", 10)
    assert dict(map(tuple, spelling.count_words(frame(rows)).collect())) == want


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {tuple(r) for r in queries.op12_spelling_variants(spark, sf).collect()}
    assert got == plain_groups(plain_words(rows, 199)) and got

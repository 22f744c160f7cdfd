"""Replacements by table against replacing the terms one after the other."""

import random

import pytest
from pyspark.sql import functions as F

from civiltext import tables
from civiltext.operators import replacing, rewriting as rw
from goldens import TEXTS


def table_of(spark, pairs):
    return spark.createDataFrame([(t, n, i) for i, (t, n) in enumerate(pairs.items())],
                                 "term string, neutral string, ord int")


def both(spark, pairs, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    one = rw.replace_words(df, "text", "out", "log", rw.Wording(replacements=pairs))
    other = rw.replace_words(df, "text", "out", "log", rw.Wording(table=table_of(spark, pairs)))

    def rows(df):
        return sorted((r.id, r.out, None if r.log is None else [tuple(c) for c in r.log])
                      for r in df.collect())

    return rows(one), rows(other)


STOCK = [t[0] for t in TEXTS] + [None, "", " ", "Kill YOURSELF, stupid stupid idiots! KİLL ıdiot"]
CASCADES = {"aa bb cc": "aa dd", "dd ee": "ff", "aa dd": "gg", "ff": "aa", "gg": "ff gg", "xx": "",
            "xx yy": "xx xx", "c++": "cee", "-": "", "$x": "y", "joined": "split up", " ": "z"}
CASCADED = ["aa bb cc ee", "AA BB CC dd ee gg", "xx yy, xx", "c++ c++x", "c++-c++", "join-ed joi-ned",
            "a$x b $x c$x", "aa  bb cc", "aa dd ee", "gg-ff", "ff" * 3]


@pytest.fixture(params=["in the row", "by digest"])
def path(request, monkeypatch):
    if request.param == "by digest":
        from civiltext.operators import broadcasts
        monkeypatch.setattr(replacing, "MAX_ROWS", -1)
        monkeypatch.setattr(broadcasts, "MAX_BROADCAST_BYTES", 1)


def test_stock_table(spark, path):
    expected, got = both(spark, tables.REPLACEMENTS, STOCK)
    assert got == expected and any(log for _, _, log in got)


def test_cascades_and_odd_terms(spark, path):
    expected, got = both(spark, CASCADES, CASCADED + STOCK)
    assert got == expected


def test_random_tables(spark, path):
    rng = random.Random(11)
    words = ["a", "b", "ab", "é", "Ça", "x-y", "q"]
    pairs = {" ".join(rng.choices(words, k=rng.randrange(1, 4))):
             " ".join(rng.choices(words, k=rng.randrange(0, 3))) for _ in range(25)}
    texts = [" ".join(rng.choices([*words, "A", ",", "zz"], k=rng.randrange(12))) for _ in range(60)]
    expected, got = both(spark, {t: n for t, n in pairs.items() if t}, texts)
    assert got == expected


def test_whole_rewrite_by_table(spark):
    df = spark.createDataFrame([(t,) for t in STOCK], "text string")
    columns = ["neutral_text", "strategy_used", "neutralization_score", "changes_made"]
    one = rw.neutralize(df).select(*columns)
    other = rw.neutralize(df, wording=rw.Wording(
        table=table_of(spark, tables.REPLACEMENTS))).select(*columns)
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    with pytest.raises(ValueError):
        rw.Wording(table=df).add_replacement("a", "b")


def test_many_terms_and_repeated_rows(spark, path):
    many = {f"term{i}": f"word{i}" for i in range(20_000)}
    listed = table_of(spark, many).unionByName(spark.createDataFrame(
        [("term7", "seven", 50_000), (None, "x", 1), ("  ", "x", 2)],
        "term string, neutral string, ord int"))
    df = spark.createDataFrame([(1, "TERM7 term19999 term20000")] * 3 + [(None, None)],
                               "id int, text string")
    out = rw.replace_words(df, "text", "out", "log", rw.Wording(table=listed)).collect()
    assert sorted(str(r.out) for r in out) == ["None"] + ["seven word19999 term20000"] * 3
    empty = rw.replace_words(df, "text", "out", "log", rw.Wording(table=listed.limit(0)))
    assert empty.filter(F.col("out") == F.col("text")).count() == 3


def test_word_by_word_is_one_after_the_other():
    """a table of single words, in chains, with several words and none in the wording."""
    rng = random.Random(3)
    words = ["a", "ab", "abc", "é", "Ça", "q_1", "B", "x2", "ß"]
    for _ in range(200):
        terms = rng.sample(words, 6)
        neutrals = [rng.choice(["", "-", "a", "ab, B", " Ça", "x2-q_1 ", "É", "abc", terms[0]]) for _ in terms]
        own = replacing.Replacer(terms, neutrals)
        assert own.by_word
        for _ in range(10):
            text = "".join(rng.choices([*words, "A", "Ab", " ", "-", ", ", "ÇA", "zz "], k=rng.randrange(12)))
            want = own._in_turn(text, None)
            assert own._word_by_word(text) == want, (terms, neutrals, text)
            assert own.replace(text) == (want[0], [(terms[i], neutrals[i]) for i in want[1]])
    assert not replacing.Replacer(["a b"], ["c"]).by_word and not replacing.Replacer(["c+"], ["c"]).by_word
    assert not replacing.Replacer(["a"], ["ᾀ"]).by_word


def test_table_of_words_makes_no_automaton(monkeypatch):
    """what a text costs goes by its words, not by the terms in it times its length."""
    own = replacing.Replacer(["abc", "ab"], ["ab", "a"])
    monkeypatch.setattr(replacing.Replacer, "occurring", None)
    assert own.replace("Abc ab abcd-abc") == ("a a abcd-a", [("abc", "ab"), ("ab", "a")])


def test_first_words():
    for text in ["", "Ab ab-c", "é_1\n x!!", "ΑΣͅ"]:
        assert replacing._first_words(text) == set(replacing._FIRST.findall(replacing.fold(text)))

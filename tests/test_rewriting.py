import functools

import pytest
from pyspark.sql import functions as F

from civiltext import tables
from civiltext.functions import patterns
from civiltext.operators import rewriting as rw
from goldens import TEXTS


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t[0]) for i, t in enumerate(TEXTS)], "id int, text string")


@pytest.mark.parametrize("strategy,column", [
    ("combined", 4), ("rule_based", 4), ("word_replacement", 5), ("transformer", 5)])
def test_rewrite_goldens(texts, strategy, column):
    for r in rw.neutralize(texts, strategy=strategy).collect():
        assert r.neutral_text == TEXTS[r.id][column], r.id


def test_change_log_and_score(texts):
    rules = {n + 1: (p, r) for n, (p, r) in
             enumerate((p, r) for p, r in tables.PHRASE_RULES)}
    combined = {r.id: r for r in rw.neutralize(texts).collect()}
    words = {r.id: r for r in rw.neutralize(texts, strategy="word_replacement").collect()}

    def log(row):
        return [(c.old, c.new) for c in row.changes_made]

    assert log(words[1]) == [("destroy", "change")] and words[1].neutralization_score == 0.146
    assert log(combined[1]) == [("destroy", "change"), rules[7]]
    assert combined[1].neutralization_score == 0.458
    assert log(words[2]) == [("worthless", "struggling"), ("pathetic", "disappointing")]
    assert words[2].neutralization_score == 0.333
    assert log(combined[2])[2:] == [rules[4], rules[7]]
    assert combined[2].neutralization_score == 1.0
    assert combined[6].neutralization_score == 0.63
    assert log(words[11]) == [("piss off", "go away"), ("go away", "please leave"),
                              ("clown", "person"), ("damn", "very")]
    assert words[11].neutralization_score == 0.889
    assert combined[0].strategy_used == "sentence_rewrite"
    assert combined[0].neutralization_score == 1.0
    assert words[5].strategy_used == "none" and words[5].neutralization_score == 0.0


def test_blank_text_is_unchanged(spark):
    df = spark.createDataFrame([("",), (" \n",), (None,)], "text string")
    for r in rw.neutralize(df).collect():
        assert r.neutral_text == r.text and r.strategy_used == "none"
        assert r.changes_made == [] and r.neutralization_score == 0.0


def one_by_one(df, wording):
    """Plain sequential replacement: what grouped replacement has to equal."""
    return df.select("id", functools.reduce(
        lambda c, pair: F.regexp_replace(c, patterns.whole_word(pair[0]),
                                         patterns.escape_replacement(pair[1])),
        wording.application_order(), F.col("text")).alias("out"))


@pytest.mark.parametrize("extra", [
    {}, {"lost away": "found", "please": "kindly", "go": "walk", "a$s": "x\\y$1"},
    {"person": "human", "very": "", "größe": "size", "leave now": "stay"}])
def test_grouped_replacement_equals_sequential(spark, extra):
    wording = rw.Wording()
    for toxic, neutral in extra.items():
        wording = wording.add_replacement(toxic, neutral)
    texts = [t[0] for t in TEXTS] + [
        "STUPID Idiot; id-iot assess ass's fucking-fuck ſtupid İdiot kıll Kill",
        "piss off away, please leave now get lost away go away", "a$s größe GRÖSSE Größen",
        "shut up shut  up shut\nup hate.hate_hate hateé éhate", "", "bastard person very"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = rw.replace_words(df, "text", "out", "log", wording).select("id", "out")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in one_by_one(df, wording).collect()}


def test_title_case_runs(spark):
    df = spark.createDataFrame([("you're x1 a ABC déjà été_is größe ok",)], "t string")
    assert df.select(rw.title_case_runs(F.col("t"))).first()[0] == \
        "You'Re x1 a Abc déjà été_is größe Ok"
    assert df.select(rw.title_case_runs(F.col("t"), shout_only=True)).first()[0] == \
        "you're x1 a Abc déjà été_is größe ok"


def test_rules_with_custom_tables(spark):
    wording = rw.Wording(replacements={})
    df = spark.createDataFrame([(0, "i'll kill them"), (1, "Well, I hate everyone!!"),
                                (2, "go fuck yourself")], "id int, text string")
    got = {r.id: r.neutral_text for r in rw.neutralize(df, wording=wording).collect()}
    assert got == {0: "I Would Like To Change Them.",
                   1: "Well, I Strongly Disagree With Everyone.",
                   2: "Please Excuse Yourself."}


def test_texts_with_the_marks_used_inside(spark):
    own = "\ufdd2\ufdd3 stupid \ufdd2 \ufdd2\ufdd4 idiot \ufdd3"
    df = spark.createDataFrame([(1, own)], "id int, text string")
    got = rw.replace_words(df, "text", "out", "log").first().out
    assert got == own.replace("stupid", "mistaken").replace("idiot", "person")

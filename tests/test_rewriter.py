"""Texts rewritten in a worker against the same steps as column expressions."""

import random

import pytest
from pyspark.sql import functions as F

from civiltext import tables
from civiltext.operators import lookup, rewriter, rewriting as rw
from civiltext.plans import catalog

ODD = ["", " \n", "you  are SO stupid!!! i hate ALL", "YOU ARE very\tkalt", "i'll kill i", "ünder GO AWAY",
       "I am going to harm  it \x1c\x85 x", "ſo stupid KİLL ıdiot a_b a1 ABc x", "straße ss",
       "ßa i.", "go füx yourself!!", " i　", "so very", "a!!b!!!c", "ŉ o", "ΑΣ so ΣΑΣ", "i", "x?"]


def texts():
    rng = random.Random(5)
    words = ["you", "are", "so", "VERY", "i", "hate", "all", "go", "to hell", "'ll", "kill ", "!!", "é", "a1",
             "ſtupid", "\t", "idiot", "x_", "K", "ok.", "awful"]
    return ODD + [" ".join(rng.choices(words, k=rng.randrange(14))) for _ in range(150)]


@pytest.mark.parametrize("shout", [False, True])
def test_rules_and_clean_up_are_those_of_the_columns(spark, shout):
    """each step by itself."""
    df = spark.createDataFrame(list(enumerate(texts())), "id int, t string")
    rules = tables.PHRASE_RULES + [("(b)?x", r"$\1\\!"), ("ünd", "Ünd")]
    done = rw.final_cleanup(df, "t", "clean").select("id", "t", "clean", *[
        rw.apply_rule(F.col("t"), *pair, shout).alias(f"r{i}") for i, pair in enumerate(rules)])
    for row in done.collect():
        assert rewriter.clean_up(row.t) == row.clean, row.t
        for i, pair in enumerate(rules):
            assert rewriter.rule(*pair, shout)(row.t) == row[f"r{i}"], (row.t, pair)


@pytest.mark.parametrize("strategy", rw.STRATEGIES)
def test_neutralize_is_its_steps(spark, strategy):
    """texts and logs of all steps, those of the columns."""
    df = spark.createDataFrame(list(enumerate([*texts(), None])), "id int, text string")
    made = rw.replace_words(df, "text", "words", "log")
    if strategy in ("combined", "rule_based"):
        made = rw.phrase_rules(made, "words", "ruled", "more")
    else:
        made = made.withColumns({"ruled": F.col("words"), "more": F.slice("log", 1, 0)})
    want = {r.id: r for r in rw.final_cleanup(made, "ruled", "out").collect()}
    for row in rw.neutralize(df, strategy=strategy).collect():
        if row.strategy_used != "sentence_rewrite" and (row.text or "").strip():
            assert row.neutral_text == want[row.id].out
            assert row.changes_made == want[row.id].log + want[row.id].more


def test_folded_characters():
    """what is kept for a character is what it folds to."""
    for code in [*range(0x80, 0xD800), *range(0xE000, 0x11000), 0x10400]:
        char = chr(code).translate(lookup._ODD)
        low = char.upper().lower()
        assert lookup.fold(chr(code)) == (low if len(low) == 1 else char)


def test_strategies_share_their_texts(spark, tmp_path):
    """the remarks are made once, and no step of a strategy is a column of its own."""
    spark.createDataFrame([(1, "you are so stupid with all", "en")], "doc_id long, text string, lang string") \
         .write.parquet(f"{tmp_path}/documents.parquet")
    out = catalog.strategy_switch(spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and plan.count("ArrowEvalPython") == len(rw.STRATEGIES)
    assert {(r.strategy, r.texts) for r in out.collect()} == {(s, 1) for s in rw.STRATEGIES}

import pytest
from pyspark.sql import functions as F

from civiltext.functions import numbers, text as txt
from civiltext.operators import detection as det
from civiltext.operators.lexicon import Lexicon, terms_per_category
from goldens import CLEANED, TEXTS


def render(hits):
    return " ".join(f"{h.word}/{h.category}/{h.position}"
                    + ("+i" if h.has_intensifier else "") + ("+n" if h.is_negated else "")
                    for h in hits)


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t[0]) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id int, text string").repartition(3)


@pytest.mark.parametrize("for_model", [True, False])
def test_cleaning_goldens(spark, for_model):
    df = spark.createDataFrame([(i, t[0]) for i, t in enumerate(CLEANED)], "id int, text string")
    got = df.select("id", txt.preprocess(F.col("text"), for_model=for_model).alias("c"))
    expected = {i: t[1 if for_model else 2] for i, t in enumerate(CLEANED)}
    assert {r.id: r.c for r in got.collect()} == expected


def test_stopwords_keep_negation(spark):
    df = spark.createDataFrame([("I am not very happy, don't cannot",)], "text string")
    got = df.select(txt.preprocess(F.col("text"), remove_stops=True)).first()[0]
    assert got == "not very happy not"


def test_detection_goldens(texts):
    got = det.detect(texts).withColumn("n", F.size(txt.words_lower(F.col("text")))).collect()
    for r in got:
        _, tokens, hits, intensity, _, _ = TEXTS[r.id]
        assert (r.n, render(r.toxic_words), r.intensity_score) == (tokens, hits, intensity)
        assert r.toxic_count == len(r.toxic_words)
        assert r.categories_found == sorted({h.category for h in r.toxic_words})
        assert len(r.non_toxic_words) == r.n - sum(not h.is_phrase for h in r.toxic_words)


def test_join_form_equals_array_form(spark, texts):
    array_form = det.detect(texts).select("id", F.inline("toxic_words"))
    join_form = det.detect_by_join(texts, "id", Lexicon.default().table(spark))
    assert sorted(map(tuple, array_form.collect())) == sorted(map(tuple, join_form.collect()))


def test_lexicon_counts_and_override(spark):
    lex = Lexicon.default()
    assert len(lex.terms) == 92 and len(lex.phrases) == 23
    assert lex.category["bitch"] == lex.category["bastard"] == "obscene"
    counts = {r.category: r.terms for r in terms_per_category(lex.table(spark)).collect()}
    assert counts == {"insult": 26, "obscene": 24, "threat": 16, "aggressive": 14, "hate": 12}
    more = lex.add_words(["Stupid", "rude man"], "custom")
    assert more.category["stupid"] == "custom" and lex.category["stupid"] == "insult"
    df = spark.createDataFrame([("a rude man, Stu-pid!",)], "text string")
    assert render(det.detect(df, lexicon=more).first().toxic_words) == \
        "rude man/custom/-1 stupid/custom/3"


def test_blank_and_null(spark):
    df = spark.createDataFrame([("",), ("   \n",), (None,)], "text string")
    for r in det.detect(df).collect():
        assert r.toxic_words == [] and r.intensity_score == 0.0 and r.non_toxic_words == []


def test_highlight(spark):
    df = spark.createDataFrame([("You IDIOT! idiot <b> idiotic, (Idiot)",)], "text string")
    r = det.detect(df).first().highlighted_text
    assert r.count("<mark") == 3 and "&lt;b&gt;" in r and ">IDIOT</mark>!" in r
    assert "idiotic" in r


def test_texts_cannot_forge_marks(spark):
    own = "\ufdd0 stupid\ufdd1 \ufdd2\ufdd4 idiot\ufdd0 \ufdd2\ufdd3\ufdd5"
    r = det.detect(spark.createDataFrame([(own,)], "text string")).first().highlighted_text
    assert r.count("<mark") == r.count("</mark>") == 2
    assert r.replace("</mark>", "").replace(r[r.index("<mark"):r.index(">") + 1], "") == own


def test_long_runs_of_blanks(spark):
    long = "a" + " " * 500_000 + "\n" + "\u2003" * 500_000 + "b"
    df = spark.createDataFrame([(f"  {long}\t\x85",)], "text string")
    assert df.select(txt.strip_space(F.col("text"))).first()[0] == long
    assert det.detect(df).first().non_toxic_words == ["a", "b"]


def test_short_phrases_and_texts(spark):
    lexicon = Lexicon([("b ", "x"), ("x y", "x"), (" ", "y"), ("zz", "w"), ("long phrase", "p")])
    rows = [(1, "a b c x y"), (2, "b "), (3, "x"), (4, " "), (5, None), (6, "a long phrase"), (7, "")]
    df = spark.createDataFrame(rows, "id int, text string")
    array_form = det.detect(df, lexicon=lexicon).select("id", F.inline("toxic_words"))
    join_form = det.detect_by_join(df, "id", lexicon.table(spark))
    assert sorted(map(tuple, array_form.collect())) == sorted(map(tuple, join_form.collect()))


@pytest.fixture
def by_digest(monkeypatch):
    """Makes every lexicon too large for the tasks, and every table for a broadcast."""
    from civiltext.operators import broadcasts
    monkeypatch.setattr(broadcasts, "MAX_BROADCAST_BYTES", 1)
    monkeypatch.setattr(det, "MAX_INDEX_ROWS", 0)
    monkeypatch.setattr(det, "AUTOMATON_BYTES", 60)


def test_salted_join_equals_lookup(spark, texts, request):
    small = det.detect_by_join(texts, "id", Lexicon.default().table(spark)).collect()
    request.getfixturevalue("by_digest")
    salted = det.detect_by_join(texts, "id", Lexicon.default().table(spark)).collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, salted))


TABLE_COLUMNS = ["id", "toxic_words", "toxic_count", "categories_found", "intensity_score",
                 "highlighted_text", "non_toxic_words"]


def table_forms(spark, texts):
    rows = texts.union(texts.limit(3)).union(spark.createDataFrame(
        [(None, "a stupid row"), (None, None), (1, ""), (2, " \t "), (3, "<b> (IDIOT), &idiot; x")],
        "id int, text string"))
    lexicon = Lexicon.default()
    expected = sorted(map(str, det.detect(rows).select(*TABLE_COLUMNS).collect()))
    got = det.detect_table(rows, lexicon.table(spark)).select(*TABLE_COLUMNS)
    assert sorted(map(str, got.collect())) == expected


def test_table_form_equals_array_form(spark, texts):
    table_forms(spark, texts)


def test_joined_table_form_equals_array_form(spark, texts, by_digest):
    table_forms(spark, texts)


def marks(spark, lexicon, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "id int, text string")
    return (sorted((r.id, r.highlighted_text) for r in det.detect(df, lexicon=lexicon).collect()),
            sorted((r.id, r.highlighted_text) for r in det.detect_table(
                df, lexicon.table(spark)).collect()))


ODD_TERMS = Lexicon([("hit!", "x"), ("hit", "x"), ("$bad", "y"), ("f-off", "x"), ("straße", "z"),
                     ("kelvin", "z"), ("\u03c3\u03b1\u03c2", "z"), ("...", "y"), ("a b", "p")])
ODD_TOKENS = ["(hit!!) hit! hit", "$$$bad $BAD: bad", "F-OFF, foff f-off hit", "STRASSE Straße hit",
              "\u212aelvin kelv\u0131n hit", "\u03a3\u0391\u03a3 hit", "hit ..... x...y ...",
              "nothing", "hit" + "!" * 3000]


def test_odd_terms_are_marked_alike(spark):
    expected, got = marks(spark, ODD_TERMS, ODD_TOKENS)
    assert got == expected


def test_odd_terms_are_marked_alike_by_join(spark, by_digest):
    expected, got = marks(spark, ODD_TERMS, ODD_TOKENS)
    assert got == expected


def test_lexicon_of_many_terms(spark):
    """More terms than expressions can hold give the same marks as a plain lookup."""
    more = [(f"word{i}", "custom") for i in range(6000)] + [(f"two {i}", "custom") for i in range(300)]
    lexicon = Lexicon.default().listing + more
    rows = spark.createDataFrame([(1, "Word17, two 299 idiot <word5999> word6000")],
                                 "id int, text string")
    got = det.detect_table(rows, Lexicon(lexicon).table(spark)).first()
    assert [h.word for h in got.toxic_words] == [
        "two 2", "two 29", "two 299", "word17", "idiot", "word5999"]
    assert got.highlighted_text.count("<mark") == 3 and "word6000" in got.non_toxic_words
    with pytest.raises(ValueError):
        det.detect(rows, lexicon=Lexicon(lexicon))


def test_rounding_follows_exact_value(spark):
    values = [0.0625, 0.1455, 0.0005, 0.0015, 0.0025, 0.3335, 1.0, 0.0, 2 / 3, 0.9995,
              0.1005, 0.2675, 0.12345, 0.99995] + [i / 997 for i in range(997)] \
        + [i / 2000 for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.select("x", numbers.round_exact(F.col("x"), 3).alias("a"),
                       numbers.round_exact(F.col("x"), 4).alias("b")).collect():
        assert (r.a, r.b) == (round(r.x, 3), round(r.x, 4)), r.x


def test_char_classes_match_python(spark):
    """Word and space classes agree with Python's on every code point."""
    import re
    codes = spark.range(0x110000).filter("id < 55296 or id > 57343")
    from civiltext.functions.patterns import SPACE, WORD
    ch = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    got = codes.select("id", ch.rlike(f"^[{WORD}]$").alias("w"), ch.rlike(f"[{SPACE}]").alias("s"))
    spaces = {r.id for r in got.filter("s").collect()}
    assert spaces == {i for i in range(0x110000) if chr(i).isspace()}
    assert got.filter("w").count() > 100_000
    assert {r.id for r in got.filter("w and id < 256").collect()} == \
        {i for i in range(256) if re.match(r"\w", chr(i))}


def test_strip_accents(spark):
    df = spark.createDataFrame([("Ébène größe ñandú é Ångström plain",)], "t string")
    assert df.select(txt.strip_accents(F.col("t"))).first()[0] == \
        "Ebene große nandu e Angstrom plain"


def test_accents_of_all_code_points(spark):
    import unicodedata as u
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(map(chr, points[i:i + 4096])) for i in range(0, len(points), 4096)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for r in df.select("id", txt.strip_accents(F.col("t")).alias("t")).collect():
        want = "".join(c for ch in texts[r.id] for c in u.normalize("NFKD", ch) if not u.combining(c))
        assert r.t == want, r.id

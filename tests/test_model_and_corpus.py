import math

import pytest
from pyspark.sql import functions as F

from civiltext import tables
from civiltext.functions import text as txt
from civiltext.operators import classifier as clf, exploration as ex, features as ft, sampling as sm
from civiltext.operators.lemmas import lemmatize, noun_lemmas
from civiltext.sources import corpus as cp
from civiltext.sources.shared import scratch_path

SENTENCES = [
    ("What an idiot parked this van", 1, 0, 0, 0, 1, 0),
    ("Someone should attack that village tonight", 1, 1, 0, 1, 0, 0),
    ("Pure shit, as obscene as it gets", 1, 0, 1, 0, 0, 0),
    ("Lunch is served on the terrace", 0, 0, 0, 0, 0, 0),
    ("Our train leaves from platform four", 0, 0, 0, 0, 0, 0),
    ("Rain is expected along the coast", 0, 0, 0, 0, 0, 0),
    ("Only a moron or a fool buys this", 1, 0, 0, 0, 1, 0),
    ("The choir sang two more songs", 0, 0, 0, 0, 0, 0),
    ("They despise foreigners and say it", 1, 0, 0, 0, 0, 1),
    ("Please bring your own cups", 0, 0, 0, 0, 0, 0),
]


@pytest.fixture(scope="module")
def small_set(spark):
    rows = [(f"r{i}", *SENTENCES[i % 10]) for i in range(500)]
    schema = "id string, comment_text string, " + ", ".join(f"{c} int" for c in tables.LABELS)
    return spark.createDataFrame(rows, schema).repartition(4)


@pytest.fixture(scope="module")
def trained(small_set):
    return clf.train(small_set)


def test_train_metrics_and_predictions(spark, trained):
    model, metrics = trained
    got = {r.label: r for r in metrics.collect()}
    assert set(got) == set(tables.LABELS) and model.skipped == []
    assert all(r.accuracy == 1.0 and r.f1 == 1.0 for r in got.values())
    df = spark.createDataFrame([("An idiot, only an idiot parked this!",),
                                ("Two more songs on the terrace!",), (None,)], "text string")
    toxic, clean, missing = model.predict(df).collect()
    assert toxic.is_toxic and "insult" in toxic.detected_types
    assert toxic.clean_text == "an idiot only an idiot parked this"
    assert toxic.confidence == max(toxic.labels.values())
    assert set(clean.labels) == set(tables.LABELS)
    assert missing.clean_text == ""
    report = ex.evaluation_report(metrics).collect()
    assert [r.label for r in report] == tables.LABELS + ["AVERAGE"]


def test_gradient_is_zero_at_the_solution(small_set, trained):
    """The solution minimizes half the squared norm plus the balanced log loss."""
    model, _ = trained
    train, _ = sm.train_test_split(small_set, "id")
    clean = train.select("toxic", txt.preprocess(F.col("comment_text")).alias("clean_text"))
    rows = model.tfidf.transform(clean).select("toxic", "features").collect()
    n, pos = len(rows), sum(r.toxic for r in rows)
    weights, intercept = model.coefficients("toxic"), model.intercepts[model.labels.index("toxic")]
    gradient = weights.copy()
    for r in rows:
        p = 1 / (1 + math.exp(-(r.features.dot(weights) + intercept)))
        weight = n / (2 * (pos if r.toxic else n - pos))
        for i, v in zip(r.features.indices, r.features.values):
            gradient[i] += weight * (p - r.toxic) * v
    assert abs(gradient).max() < 1e-2


def test_regression_agrees_with_spark(spark, small_set, trained):
    """Spark's own regression of one label, run until it stops, finds the same weights."""
    from pyspark.ml.classification import LogisticRegression
    model, _ = trained
    train, _ = sm.train_test_split(small_set, "id")
    rows = model.tfidf.transform(train.withColumn("clean_text", txt.preprocess(F.col("comment_text"))))
    totals = {c["label"]: c for c in model.training}
    for label in ("toxic", "insult"):
        n, pos = totals[label]["rows"], totals[label]["positives"]
        weighted = rows.select("features", F.col(label).cast("double").alias("label"), F.when(
            F.col(label) == 1, n / (2 * pos)).otherwise(n / (2 * (n - pos))).alias("w"))
        other = LogisticRegression(maxIter=500, tol=1e-10, regParam=1 / n, standardization=False,
                                   weightCol="w").fit(weighted)
        assert abs(other.coefficients.toArray() - model.coefficients(label)).max() < 0.01
        assert other.intercept == pytest.approx(
            model.intercepts[model.labels.index(label)], abs=0.01)


def test_labels_trained_together_as_alone(small_set, trained):
    alone, metrics = clf.train(small_set, labels=["insult"])
    both = trained[0]
    assert abs(alone.coefficients("insult") - both.coefficients("insult")).max() < 0.01
    assert metrics.collect() == trained[1].filter("label = 'insult'").collect()
    assert all(c["gradient"] <= 0.01 for c in both.training)


def test_metrics_are_those_of_the_predictions(spark, small_set, trained):
    model, metrics = trained
    _, test = sm.train_test_split(small_set, "id")
    predicted = model.predict(test, "comment_text", threshold=0.5).collect()
    for row in metrics.collect():
        pairs = [(r[row.label], row.label in r.detected_types) for r in predicted]
        assert row.accuracy == sum(a == b for a, b in pairs) / len(pairs)
        called = sum(b for _, b in pairs)
        assert row.precision == (sum(a and b for a, b in pairs) / called if called else 0)


def test_importances_are_the_largest_coefficients(spark, trained):
    model, _ = trained
    got = [tuple(r) for r in model.feature_importance(spark, "insult", 7).collect()]
    every = sorted(zip(model.tfidf.terms, model.coefficients("insult").tolist()),
                   key=lambda p: (-p[1], p[0]))
    assert got == every[:7]


def test_save_and_load(spark, trained):
    model, _ = trained
    path = scratch_path(spark, "model")
    model.save(spark, path)
    again = clf.ToxicityModel.load(spark, path)
    assert again.training == model.training and (again.tables == model.tables).all()
    df = spark.createDataFrame([(s[0],) for s in SENTENCES], "text string")
    assert model.predict(df).collect() == again.predict(df).collect()
    top = again.feature_importance(spark, "insult", 5).collect()
    assert len(top) == 5 and top[0].importance >= top[-1].importance
    with pytest.raises(ValueError):
        again.feature_importance(spark, "nope")


def test_naive_bayes_matches_formula(spark, small_set):
    model, metrics = clf.train(small_set, model_type="naive_bayes", labels=["toxic"])
    train, _ = sm.train_test_split(small_set, "id")
    clean = train.select("toxic", txt.preprocess(F.col("comment_text")).alias("clean_text"))
    rows = model.tfidf.transform(clean).collect()
    size = len(model.tfidf.terms)
    sums = {0: [0.1] * size, 1: [0.1] * size}
    for r in rows:
        for i, v in zip(r.features.indices, r.features.values):
            sums[r.toxic][i] += v
    x = model.tfidf.transform(spark.createDataFrame([("only a moron sang",)], "clean_text string"))
    x = x.first().features
    score = {c: math.log(sum(r.toxic == c for r in rows) / len(rows))
             + sum(v * math.log(sums[c][i] / sum(sums[c])) for i, v in zip(x.indices, x.values))
             for c in (0, 1)}
    expected = 1 / (1 + math.exp(score[0] - score[1]))
    got = model.predict(spark.createDataFrame([("Only a moron sang",)], "text string")).first()
    assert got.labels["toxic"] == pytest.approx(expected, abs=1e-4)
    with pytest.raises(ValueError):
        model.feature_importance(spark, "toxic")


def test_unknown_model_type(small_set):
    with pytest.raises(ValueError):
        clf.train(small_set, model_type="lstm")


def test_demo_corpus_and_one_class_label(spark):
    demo = cp.demo_corpus(spark, 600)
    rows = demo.collect()
    assert len(rows) == 600 and sum(r.toxic for r in rows) == 300
    assert sum(r.threat for r in rows) == 0 and not any("{" in r.comment_text for r in rows)
    texts = {r.id: r.comment_text for r in rows}
    assert texts["t0"] == "You are a complete idiot and I hate you!"
    assert texts["t7"] == "What a fool loser you are!"
    assert texts["c9"] == "Thank you for your help with this."
    model, _ = clf.train(demo, labels=["toxic", "threat"])
    assert model.skipped == ["threat"] and model.labels == ["toxic"]


def test_tfidf_weights_match_formula(spark):
    docs = ["aa bb aa", "aa cc x", "aa bb bb cc", "dd aa", "dd bb"]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, clean_text string")
    model = ft.TfidfModel.fit(df, min_df=2, max_df=0.9)
    got = {(r.id, r.term): r.weight for r in model.weights(df, "id").collect()}

    def terms(t):
        w = [x for x in t.split() if len(x) > 1]
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    n = len(docs)
    freq = {t: sum(t in terms(d) for d in docs) for d in docs for t in terms(d)}
    vocab = {t for t, f in freq.items() if 2 <= f <= 0.9 * n}
    assert set(model.terms) == vocab
    for i, d in enumerate(docs):
        w = {t: (1 + math.log(terms(d).count(t))) * (math.log((1 + n) / (1 + freq[t])) + 1)
             for t in set(terms(d)) & vocab}
        norm = math.sqrt(sum(v * v for v in w.values()))
        for t, v in w.items():
            assert got.pop((i, t)) == pytest.approx(v / norm)
    assert not got


def test_balanced_sample_is_exact_and_stable(spark):
    df = spark.range(20_000).withColumn("toxic", (F.col("id") % 10 == 0).cast("int"))
    first = sm.balanced_sample(df, "id", size=1000)
    second = sm.balanced_sample(df.repartition(7), "id", size=1000)
    ids = {r.id for r in first.collect()}
    assert len(ids) == 1000 and ids == {r.id for r in second.collect()}
    assert first.filter("toxic = 1").count() == 250
    assert sm.balanced_sample(df, "id", size=30_000).count() == 20_000
    with pytest.raises(ValueError):
        sm.balanced_sample(df.filter("toxic = 1 or id < 100"), "id", size=1500)


def test_split_is_disjoint_and_complete(spark):
    df = spark.range(5000)
    train, test = sm.train_test_split(df, "id")
    assert train.count() + test.count() == 5000 and train.join(test, "id").count() == 0
    assert 900 < test.count() < 1100


def test_csv_round_trip(spark):
    rows = [("a", 'He said "no"\nand, left', 1, 0), ("b", "plain", 0, 1)]
    df = spark.createDataFrame(rows, "id string, comment_text string, toxic int, insult int")
    path = scratch_path(spark, "csv")
    cp.write_labeled_csv(df, path)
    back = cp.read_labeled_csv(spark, path)
    assert back.columns == df.columns and sorted(map(tuple, back.collect())) == sorted(rows)
    assert cp.load_dataset(spark, path).count() == 2
    assert cp.load_dataset(spark, path + "-missing").count() == 2000


def test_lemma_lookup(spark):
    nouns = spark.createDataFrame([("dog",), ("man",), ("glass",), ("ass",)], "noun string")
    odd = spark.createDataFrame([("mice", "mouse"), ("oxen", "ox")], "form string, lemma string")
    nouns = nouns.union(spark.createDataFrame([("mouse",)], "noun string"))
    forms = spark.createDataFrame([(w,) for w in "dogs men glass glasses mice oxen run dogss".split()],
                                  "form string")
    table = noun_lemmas(forms, nouns, odd)
    assert {r.form: r.lemma for r in table.collect()} == {
        "dogs": "dog", "men": "man", "glass": "glass", "glasses": "glass", "mice": "mouse",
        "dogss": "dog"}
    df = spark.createDataFrame([(1, "dogs run men dogs"), (2, "run"), (3, "")],
                               "id int, clean string")
    got = {r.id: r.out for r in lemmatize(df, "clean", table, "out").collect()}
    assert got == {1: "dog run man dog", 2: "run", 3: ""}
    assert lemmatize(df, "clean", None, "out").filter("out <> clean").count() == 0


@pytest.mark.parametrize("small", [True, False])
def test_lemmas_need_no_ids(spark, monkeypatch, small):
    from civiltext.operators import broadcasts
    if not small:
        monkeypatch.setattr(broadcasts, "MAX_BROADCAST_BYTES", 1)
    table = spark.createDataFrame([("dogs", "dog"), ("runs", "run"), ("dog", "dog")],
                                  "form string, lemma string")
    rows = [(1, "dogs run"), (1, "run dogs"), (1, "runs dogs runs"), (None, "dogs"), (None, "cat"),
            (None, None), (2, "dogs run"), (2, "")]
    df = spark.createDataFrame(rows, "id int, clean string")
    got = [(r.id, r.out) for r in lemmatize(df, "clean", table, "out").collect()]
    swap = {"dogs": "dog", "runs": "run"}
    expected = [(i, t if t is None else " ".join(swap.get(w, w) for w in t.split(" ")))
                for i, t in rows]
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_long_forms_take_one_pass(spark):
    forms = spark.createDataFrame([("a" + "s" * 60,), ("b" + "ses" * 12,)], "form string")
    nouns = spark.createDataFrame([("as",), ("a",), ("bs",)], "noun string")
    assert {r.form[0]: r.lemma for r in noun_lemmas(forms, nouns).collect()} == {"a": "as", "b": "bs"}


def test_rows_without_ids(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 4 > 0, F.col("id")).alias("id"),
                                  (F.col("id") % 3 == 0).cast("int").alias("toxic"),
                                  F.concat(F.lit("text "), F.col("id")).alias("text"))
    train, test = sm.train_test_split(df, "id")
    assert train.count() + test.count() == 1000 and 120 < test.count() < 280
    sample = sm.balanced_sample(df, "id", size=400)
    assert sample.count() == 400 and sample.filter("toxic = 1").count() == 100
    assert sample.filter("id IS NULL").count() > 50


def test_training_leaves_nothing_and_takes_rows_without_ids(spark, small_set):
    from civiltext.sources.shared import shared_dir
    import os
    folder = shared_dir(spark)

    def names():
        return {n for n in os.listdir(folder) if n.startswith(("corpus-", "features-", "terms-"))}

    before = names()
    nameless = small_set.withColumn("id", F.lit(None).cast("string"))
    model, metrics = clf.train(nameless, labels=["toxic"], model_type="naive_bayes")
    assert names() == before and metrics.count() <= 1 and model.labels == ["toxic"]


def test_cleaning_belongs_to_the_model(spark, small_set):
    lemmas = spark.createDataFrame([("songs", "song"), ("idiot", "fool")],
                                   "form string, lemma string")
    model, _ = clf.train(small_set, labels=["toxic"], remove_stops=True, lemmas=lemmas)
    path = scratch_path(spark, "model")
    model.save(spark, path)
    again = clf.ToxicityModel.load(spark, path)
    df = spark.createDataFrame([("The idiot sang two songs",), (None,)], "text string")
    for m in (model, again):
        rows = m.predict(df).collect()
        assert [r.clean_text for r in rows] == ["fool sang two song", ""]
    sizes = clf.gradient_sizes(again, small_set).first()
    assert sizes.gradient < 0.02 and sizes.vocabulary == len(model.tfidf.terms)


def test_vocabulary_is_not_ranked_by_one_task(spark, monkeypatch):
    rows = [(f"t{i:04d}", 2 + (i % 7 == 0) * 5 + (i % 50 == 0) * i) for i in range(3000)]
    counts = spark.createDataFrame(rows, "term string, tf long").repartition(5)
    for k in (0, 1, 10, 59, 60, 61, 500, 2999, 3000, 4000):
        got = {r.term for r in ft.vocabulary(counts, k).collect()}
        assert got == {t for t, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:k]}, k
    monkeypatch.setattr(ft, "RANKED", 3)
    for k in (10, 59, 61, 500, 2999):
        got = {r.term for r in ft.vocabulary(counts, k).collect()}
        assert got == {t for t, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:k]}, k


def test_statistics(spark, small_set):
    assert ex.corpus_stats(small_set).first().comments == 500
    dist = {r.label: (r.positives, r.percent) for r in ex.label_distribution(small_set).collect()}
    assert dist["toxic"] == (250, 50.0) and dist["insult"] == (100, 20.0)
    assert tuple(ex.multilabel_stats(small_set).first()) == (250, 3)
    assert tuple(ex.clean_toxic_split(small_set).first()) == (250, 50.0, 250, 50.0)

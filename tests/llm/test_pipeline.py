"""Toxicity, the pipeline's stages, and the registered queries."""

import random
import re
import zlib

import brute
import corpus_pipeline
import numpy as np
import pytest
from conftest import ODD_ROWS, SF
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from civiltext.llm import decontamination, pieces, secrets, toxicity
from compare import connect, difference

TOXIC_WORDS = ["vileword", "slurterm", "hatestuff", "nastyness"]


def corpus(n=900, seed=11):
    rng = random.Random(seed)
    words = ["".join(rng.choice(["the", "an", "er", "ing", "ou", "st", "re"])
                     for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randrange(20, 200))
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                text.insert(rng.randrange(len(text)), rng.choice(TOXIC_WORDS))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def trained(spark, frame):
    rows, labels = corpus()
    docs = frame(rows)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    return docs, dict(labels), toxicity.train(docs, marks)


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_toxicity_of_held_out_documents(trained):
    docs, labels, model = trained
    got = {r.id: r.score for r in toxicity.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == len(labels)
    right = [(got[i] >= toxicity.DECISION) == labels[i] for i in labels if held_out(i)]
    assert np.mean(right) > 0.95
    kept = toxicity.drop_toxic(docs, model)
    assert {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.3}
    assert kept.columns == docs.columns


def test_held_out_labels_are_not_used(spark, trained):
    docs, labels, model = trained
    turned = [(i, 1 - x if held_out(i) else x) for i, x in labels.items()]
    marks = spark.createDataFrame(turned, "doc_id long, toxic int")
    again = toxicity.train(docs, marks)
    assert again.toxic == model.toxic and again.ordinary == model.ordinary
    assert (again.weights == model.weights).all()


def test_savings_match_single_compressions(trained):
    docs, _, model = trained
    texts = [r.text for r in docs.limit(30).collect()] + ["", " \n ", "One", "a b\tc\nD e f g h"]
    import pyarrow as pa
    plain, toxic = model.compressors()
    got = toxicity.savings(pa.array(texts), (plain, toxic))
    for row, text in zip(got, texts):
        blanks = re.sub(r"[\t\n\v\f\r]", " ", brute.lower(text))
        padded = f" {blanks} ".encode()
        spans = [m.span() for m in re.finditer(rb"[^ ]+", padded)]
        step, saved = toxicity.STEP, []
        for at in range(0, len(spans), step):
            if at and at + toxicity.WINDOW - step >= len(spans):
                break
            end = min(at + toxicity.WINDOW, len(spans)) - 1
            window = padded[spans[at][0] - 1:spans[end][1] + 1]
            saved.append(max(0, len(plain.compress(window)) - len(toxic.compress(window))))
        assert row[0] == pytest.approx(np.log1p(max(saved, default=0)))
        assert row[1] == pytest.approx(np.log1p(sum(saved)))
        assert row[4] == pytest.approx(np.log1p(len(saved)))


def test_toxicity_without_labels(spark, frame, odd):
    a, b = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 3][:2]
    docs = frame([(a, "some text"), (b, "other text")])
    for rows, expected in (([], 0), ([(a, 1), (b, 1)], 1), ([(a, 0)], 0), ([(a, None)], 0)):
        marks = spark.createDataFrame(rows, "doc_id long, toxic int")
        model = toxicity.train(docs, marks)
        scores = [r.score for r in toxicity.score(docs, model).collect()]
        assert len(scores) == 2 and all(round(s) == expected for s in scores)
    assert toxicity.score(odd, model).count() == len(ODD_ROWS)
    assert toxicity.score(frame([]), model).collect() == []
    assert sorted(map(str, toxicity.drop_toxic(odd, model).collect())) \
        == sorted(map(str, odd.collect()))


def test_near_duplicates_stage(spark, frame, odd):
    rng = random.Random(2)
    rows = []
    for group in range(20):
        base = [f"w{rng.randrange(500)}" for _ in range(50)]
        for _ in range(rng.randrange(1, 5)):
            copy = list(base)
            copy[rng.randrange(50)] = "changed"
            rows.append((rng.randrange(10**6), " ".join(copy)))
    rows += rows[:7]
    kept = corpus_pipeline.near_duplicates(spark, frame(rows), SF)
    expected = {c for _, _, c in brute.jaccard_components(rows, 5, "0.8")}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)
    assert kept.columns == frame(rows).columns
    ids = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, odd, SF).collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [1, 2, 3, None, None, 4, 5, 6, 7, 8]))


def test_pipeline_matches_plain_versions(spark, tables):
    docs = tables("documents")
    model = toxicity.train(docs, tables("labels"))
    clean = [(r.id, r.score) for r in toxicity.score(docs, model).collect()]
    ids = {i for i, score in clean if score < toxicity.DECISION}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in ids]
    stay = {c for _, _, c in brute.jaccard_components(rows, 5, "0.8")}
    rows = [r for r in rows if r[0] in stay]
    bad = {r.id for r in decontamination.contaminations(docs, tables("benchmark")).collect()}
    rows = [r for r in rows if r[0] not in bad]
    codec = pieces.codec()
    expected = {i: codec.encode(secrets.masked(t, secrets.all_spans(t))).tolist()
                for i, t in rows}
    got = corpus_pipeline.run(spark, SF)
    assert {r.doc_id: r.pieces for r in got.collect()} == expected
    assert got.columns == ["doc_id", "n_pieces", "pieces"]


def test_masking_stage_keeps_columns(spark, tables):
    docs = tables("documents").withColumn("text", F.concat(
        F.col("text"), F.lit(" token=abcdefgh12345678")))
    out = corpus_pipeline.secret_masking(spark, docs, SF)
    assert out.dtypes == docs.dtypes
    assert all(r.text.endswith(" [secret]") and len(r.text) == r.n_chars for r in out.collect())


def test_stages_take_odd_and_empty_tables(spark, odd, frame):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, frame([])):
            out = stage(spark, docs, SF)
            if name != "encoding":
                assert out.dtypes == docs.dtypes, name
            if name != "near_duplicates":
                assert out.count() == docs.count(), name


@pytest.mark.parametrize("name", [q for q in oracle_sql() if q.startswith("op")])
def test_query_matches_sql(spark, name):
    with connect(SF) as con:
        assert difference(queries()[name](spark, SF), con, oracle_sql()[name]) == ""


def test_every_operator_is_registered():
    numbers = {int(m[1]) for m in (re.match(r"op(\d+)_", q) for q in queries()) if m}
    assert numbers == set(range(1, 11)) and "pipeline" in queries()


def test_calibration_rows_are_bounded(spark, frame, monkeypatch):
    rows, labels = corpus(200)
    seen = []
    monkeypatch.setattr(toxicity, "_fit_curve", lambda x, y: seen.append(len(y)) or np.zeros(7))
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    toxicity.train(frame(rows), marks, calibration_rows=30)
    assert seen == [30]


def many_toxic_words(spark, frame, n=2400):
    """Documents of ordinary words, a tenth of them with a few of 150 toxic words, some short."""
    rng = random.Random(5)
    new = lambda k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=k))
    ordinary, toxic = [new(6) for _ in range(300)], [new(7) for _ in range(147)]
    toxic += ["qzx", "vkj", "wq"]
    rows, labels, turn = [], [], 0
    for i in range(n):
        text = rng.choices(ordinary, k=50)
        if i % 10 == 0:
            for at in rng.sample(range(50), 10):
                text[at] = toxic[turn % len(toxic)]
                turn += 1
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 10 == 0)))
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    return toxic, ordinary, toxicity.train(frame(rows), marks)


@pytest.mark.parametrize("size", [None, 400])
def test_every_toxic_word_counts(spark, frame, monkeypatch, size):
    if size:
        monkeypatch.setattr(toxicity, "TOXIC_BYTES", size)
    toxic, ordinary, model = many_toxic_words(spark, frame)
    learned = b"".join(model.toxic).decode().split()
    assert sum(w in learned for w in toxic) > 0.9 * len(toxic) and not set(ordinary) & set(learned)
    assert {"qzx", "vkj", "wq"} <= set(learned)
    assert len(model.toxic) == 1 if size is None else len(model.toxic) > 2
    # Ten toxic words in each text, from the rarest on, which a full dictionary left out.
    def mixed(words):
        return " ".join(w for i, word in enumerate(words)
                        for w in [*ordinary[4 * i:4 * i + 4], word])

    texts = [(i, mixed(learned[i:i + 10])) for i in range(0, len(learned) - 10, 10)]
    scores = toxicity.score(frame(texts), model).collect()
    assert all(r.score >= toxicity.DECISION for r in scores)
    clean = toxicity.score(frame([(1, " ".join(ordinary[:50]))]), model).first().score
    assert clean < toxicity.DECISION


def test_a_beginning_counts_once_per_document(spark):
    rows = [(1, "gruntal gruntel gruntil gruntol gruntul")] + [(0, f"plain text {i}")
                                                             for i in range(300)]
    counts = toxicity.term_counts(spark.createDataFrame(rows, "toxic int, text string"))
    assert [r.toxic for r in counts.filter("term = 'grunt*'").collect()] == [1]
    assert toxicity.toxic_words(counts).collect() == []

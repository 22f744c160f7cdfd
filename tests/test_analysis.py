import pytest
from pyspark.sql import functions as F

from civiltext.plans import analysis as an
from civiltext.sources.shared import scratch_path
from civiltext.streaming.moderation import analyze_folder
from goldens import TEXTS


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t[0]) for i, t in enumerate(TEXTS)] + [(100, ""), (101, " \n"), (102, None)]
    return spark.createDataFrame(rows, "id int, text string").repartition(3)


@pytest.fixture(scope="module")
def analysed(texts):
    return {r.id: r for r in an.analyze(texts).collect()}


def test_analysis_goldens(texts, analysed):
    assert an.analyze(texts).columns == ["id", "text"] + [
        c for c in an.analyze(texts).columns[2:]]
    assert set(an.analyze(texts).columns) == {"id", "text", *an.ANALYSIS}
    for i, (text, _, hits, intensity, combined, _) in enumerate(TEXTS):
        r = analysed[i]
        assert r.original_text == text and r.is_toxic == bool(hits)
        assert r.confidence == min(1.0, intensity * 2) and r.intensity_score == intensity
        assert r.neutral_text == (combined if hits else text)
        assert r.toxic_count == len(r.toxic_words)
        assert bool(r.changes_made) <= bool(hits)


def test_blank_rows(analysed):
    for i, text in ((100, ""), (101, " \n"), (102, "")):
        r = analysed[i]
        assert (r.original_text, r.neutral_text, r.highlighted_text, r.clean_text) == \
            (text, text, text, "")
        assert not r.is_toxic and r.confidence == 0.0 and r.toxicity_types == []
        assert r.changes_made == []


def test_partitioning_does_not_matter(texts, analysed):
    again = {r.id: r for r in an.analyze(texts.coalesce(1)).collect()}
    assert again == analysed


def test_plan_has_no_shuffle(spark):
    df = spark.range(10).select("id", F.lit("x").alias("text"))
    plan = an.analyze(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_report_and_summary(texts):
    a = an.analyze(texts.filter("id < 21"))
    report = {r.id: r for r in an.batch_report(a, "id").collect()}
    assert report[0].Status == "🔴 Toxic" and report[0].Confidence == "86%"
    assert report[0].Types == "hate, insult" and report[5].Types == "—"
    assert report[7].Neutralized.endswith("...") and len(report[7].Neutralized) == 73
    assert tuple(an.batch_summary(a).first()) == (21, 19, 2, 90.5)


def test_lines(spark):
    df = spark.createDataFrame([(1, " a \n\n\tb\r\n"), (2, "\n")], "id int, text string")
    assert [tuple(r) for r in an.lines_to_rows(df).collect()] == [(1, 0, "a"), (1, 1, "b")]


def test_residual_toxicity(texts):
    got = {r.id: r for r in an.residual_toxicity(an.analyze(texts)).collect()}
    assert got[18].residual_count == 1 and got[0].residual_count == 0
    assert got[13].residual_count == 0 and got[18].toxic_count == 1


def test_stream_equals_batch(spark, texts, analysed):
    source, target, check = (scratch_path(spark, n) for n in ("in", "out", "check"))
    texts.repartition(3).write.parquet(source)
    analyze_folder(spark, source, texts.schema, target, check, files_per_batch=1)\
        .awaitTermination()
    got = {r.id: r.neutral_text for r in spark.read.parquet(target).collect()}
    assert got == {i: r.neutral_text for i, r in analysed.items()}

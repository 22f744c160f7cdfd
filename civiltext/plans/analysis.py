"""End-to-end analysis of a table of texts, and the batch report.

Everything up to the report is one narrow stage: a text is cleaned, judged, explained and
rewritten in the task that read it. Only ``batch_summary`` shuffles, and only one partial
count per task.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F

from civiltext.functions import numbers, text as txt
from civiltext.functions.barrier import elements_of
from civiltext.operators.detection import detect
from civiltext.operators.lexicon import Lexicon
from civiltext.operators.rewriting import Wording, neutralize

if TYPE_CHECKING:
    from civiltext.operators.classifier import ToxicityModel

ANALYSIS = ["original_text", "clean_text", "is_toxic", "confidence", "toxicity_types",
            "toxic_words", "highlighted_text", "neutral_text", "changes_made",
            "intensity_score", "toxic_count"]
TOXIC, CLEAN, NO_TYPES = "🔴 Toxic", "🟢 Clean", "—"


def lexicon_verdict(df: DataFrame) -> DataFrame:
    """Verdict from detection columns: any hit makes a text toxic, negated or not."""
    return df.withColumns({
        "is_toxic": F.col("toxic_count") > 0,
        "confidence": F.least(F.lit(1.0), F.col("intensity_score") * 2),
        "toxicity_types": F.col("categories_found"),
    })


def analyze(df: DataFrame, text_col: str = "text", strategy: str = "combined",
            lexicon: Lexicon | None = None, wording: Wording | None = None,
            classifier: "ToxicityModel | None" = None, threshold: float = 0.3) -> DataFrame:
    """Append the eleven analysis columns.

    With a trained ``classifier`` verdict, confidence and types come from the model at
    ``threshold``; words, intensity and highlighting always come from the lexicon. Only
    toxic texts are rewritten.
    """
    found = detect(df.withColumn("_source", txt.null_to_empty(F.col(text_col))), "_source",
                   lexicon)
    if classifier is None:
        judged = lexicon_verdict(found).withColumn("clean_text", txt.preprocess(F.col("_source")))
    else:
        blank = txt.is_blank(F.col("_source"))
        judged = classifier.predict(found, "_source", threshold)
        judged = judged.withColumns({
            "is_toxic": F.col("is_toxic") & ~blank,
            "confidence": F.when(blank, F.lit(0.0)).otherwise(F.col("confidence")),
            "toxicity_types": F.when(blank, F.expr("cast(array() AS array<string>)"))
                               .otherwise(F.col("detected_types")),
        }).drop("labels", "detected_types")
    out = neutralize(judged, "_source", strategy, wording, only_when=F.col("is_toxic"))
    return (out.withColumn("original_text", F.col("_source"))
            .drop("_source", "categories_found", "non_toxic_words", "strategy_used",
                  "neutralization_score"))


def residual_toxicity(analysis: DataFrame, lexicon: Lexicon | None = None) -> DataFrame:
    """Append ``residual_count`` and ``residual_intensity``: what rewriting left behind."""
    again = detect(analysis.withColumnsRenamed(
        {"toxic_words": "_tw", "toxic_count": "_tc", "intensity_score": "_is",
         "highlighted_text": "_ht"}), "neutral_text", lexicon)
    return (again.withColumnsRenamed({"toxic_count": "residual_count",
                                      "intensity_score": "residual_intensity"})
            .drop("toxic_words", "highlighted_text", "categories_found", "non_toxic_words")
            .withColumnsRenamed({"_tw": "toxic_words", "_tc": "toxic_count",
                                 "_is": "intensity_score", "_ht": "highlighted_text"}))


def lines_to_rows(df: DataFrame, text_col: str = "text", out: str = "line") -> DataFrame:
    """One row per non-blank line, trimmed, with its number among those lines from 0."""
    lines = F.filter(F.transform(F.split(text_col, "\n"), txt.strip_space), lambda t: t != "")
    others = [c for c in df.columns if c != text_col]
    return elements_of(df, others, lines, "line_no", out)


def clip(text: Column, width: int = 70) -> Column:
    """The first ``width`` characters, with ``...`` if there are more."""
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("...")))\
            .otherwise(text)


def batch_report(analysis: DataFrame, *keep: str) -> DataFrame:
    """The readable result table, all strings. ``keep`` names columns to carry along."""
    types = F.array_join("toxicity_types", ", ")
    return analysis.select(
        *keep,
        clip(F.col("original_text")).alias("Text"),
        F.when(F.col("is_toxic"), TOXIC).otherwise(CLEAN).alias("Status"),
        numbers.percent_text(F.col("confidence")).alias("Confidence"),
        F.when(types == "", NO_TYPES).otherwise(types).alias("Types"),
        clip(F.col("neutral_text")).alias("Neutralized"))


def batch_summary(analysis: DataFrame) -> DataFrame:
    """One row: ``total, toxic, clean, toxic_rate`` (percent, one decimal)."""
    counts = analysis.agg(F.count("*").alias("total"), F.count_if("is_toxic").alias("toxic"))
    rate = counts.withColumn("_rate", F.try_divide("toxic", "total") * 100)
    return rate.select("total", "toxic", (F.col("total") - F.col("toxic")).alias("clean"),
                       numbers.round_exact(F.col("_rate"), 1).alias("toxic_rate"))


def batch_analyze(df: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """Split texts into lines and analyse every line."""
    return analyze(lines_to_rows(df, text_col), "line", **options)

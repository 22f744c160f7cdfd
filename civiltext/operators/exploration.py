"""Corpus statistics and evaluation metrics; each is one partially aggregated pass."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, functions as F

from civiltext import tables


def discover_labels(df: DataFrame, known: list[str] | None = None) -> list[str]:
    """The label columns ``df`` has, in reporting order. Looks at the schema only."""
    return [name for name in (known or tables.LABELS) if name in df.columns]


def filter_by_label(df: DataFrame, value: int = 1, label: str = "toxic") -> DataFrame:
    return df.filter(F.col(label) == value)


def label_count(labels: list[str]) -> Column:
    """How many labels a row has."""
    return functools.reduce(operator.add, (F.coalesce(F.col(c), F.lit(0)) for c in labels),
                            F.lit(0))


def corpus_stats(df: DataFrame, text_col: str = "comment_text") -> DataFrame:
    return df.agg(F.count("*").alias("comments"), F.avg(F.length(text_col)).alias("avg_length"))


def label_distribution(df: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """``label, positives, percent`` per label."""
    labels = labels or discover_labels(df)
    sums = df.agg(F.count("*").alias("_rows"),
                  *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in labels])
    return (sums.unpivot("_rows", labels, "label", "positives")
            .select("label", "positives",
                    (F.try_divide("positives", "_rows") * 100).alias("percent")))


def multilabel_stats(df: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """``multi_label`` rows with more than one label, and ``max_labels`` in a row."""
    n = label_count(labels or discover_labels(df))
    return df.agg(F.count_if(n > 1).alias("multi_label"), F.max(n).alias("max_labels"))


def clean_toxic_split(df: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Rows without and with labels, as counts and percent."""
    n = label_count(labels or discover_labels(df))
    counts = df.agg(F.count("*").alias("_rows"), F.count_if(n == 0).alias("clean"),
                    F.count_if(n > 0).alias("toxic"))
    return counts.select("clean", (F.try_divide("clean", "_rows") * 100).alias("clean_percent"),
                         "toxic", (F.try_divide("toxic", "_rows") * 100).alias("toxic_percent"))


def binary_metrics(outcomes: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 per label, 0 where undefined.

    ``outcomes`` has ``label``, ``actual`` and ``predicted`` (0/1). Rows collapse to four
    counts per label before the shuffle, so even one single label is no hot key.
    """
    hit, called = F.col("actual") == 1, F.col("predicted") == 1
    counts = outcomes.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(hit & called).alias("tp"),
        F.count_if(~hit & called).alias("fp"), F.count_if(hit & ~called).alias("fn"))

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    tp, fp, fn, n = (F.col(c) for c in ("tp", "fp", "fn", "n"))
    return counts.select("label", ratio(n - fp - fn, n).alias("accuracy"),
                         ratio(tp, tp + fp).alias("precision"),
                         ratio(tp, tp + fn).alias("recall"),
                         ratio(tp * 2, tp * 2 + fp + fn).alias("f1"))


METRICS = ["accuracy", "precision", "recall", "f1"]


def macro_average(metrics: DataFrame) -> DataFrame:
    """The unweighted mean of every metric over labels."""
    return metrics.agg(*[F.avg(m).alias(m) for m in METRICS])


def evaluation_report(metrics: DataFrame) -> DataFrame:
    """Metrics per label in reporting order, then the average; three decimals."""
    order = F.coalesce(F.array_position(F.array(*[F.lit(c) for c in tables.LABELS]),
                                        F.col("label")), F.lit(0))
    rows = metrics.withColumn("_ord", order).unionByName(
        macro_average(metrics).select(F.lit("AVERAGE").alias("label"), *METRICS,
                                      F.lit(len(tables.LABELS) + 1).alias("_ord")))
    return (rows.orderBy("_ord", "label")
            .select("label", *[F.round(m, 3).alias(m) for m in METRICS]))

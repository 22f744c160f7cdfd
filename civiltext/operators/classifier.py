"""Multi-label toxicity classifiers: linear models of all labels on shared TF-IDF features.

Both kinds are a weight per label and term and an intercept per label, so predicting is one
sparse product in the step that makes a text's vector. Training reads the texts' tokens, which are
written once: naive Bayes sums weights by label and term in one pass; logistic regression takes
one pass per step for all labels together.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from civiltext.functions import numbers
from civiltext.functions.barrier import computed_once, rows_of
from civiltext.operators import regression
from civiltext.operators.exploration import binary_metrics, discover_labels
from civiltext.operators.features import TfidfModel, token_text
from civiltext.operators.lemmas import Cleaning
from civiltext.operators.sampling import in_test_part
from civiltext.operators.sums import summed
from civiltext.sources.shared import in_parts, stored

MODEL_TYPES = ["logistic_regression", "naive_bayes"]
THRESHOLD = 0.3      # predict: a label is detected from this probability on
DECISION = 0.5       # evaluation: the models' own cut
NB_SMOOTHING = 0.1


def _check_type(model_type: str) -> None:
    if model_type not in MODEL_TYPES:
        raise ValueError(f"no such kind of model: {model_type!r}; there are {MODEL_TYPES}")


def fit_naive_bayes(training: DataFrame, labels: list[str], tfidf: TfidfModel,
                    totals: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial naive Bayes of all labels: log probabilities ``[label, class, term]`` and the
    log odds of the classes. Weights are summed by label and term in one pass."""
    size = len(tfidf.terms)
    sent = tfidf.sent(training.sparkSession)

    def sums(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        found = np.zeros((len(labels) + 1, size))
        for batch in batches:
            toxic = [batch.column(c).to_numpy() == 1 for c in labels]
            for texts, row, idx, weight in sent.value.by_piece(batch.column("tokens")):
                found[0] += np.bincount(idx, weights=weight, minlength=size)
                for i, marked in enumerate(toxic, 1):
                    own = marked[texts][row]
                    found[i] += np.bincount(idx[own], weights=weight[own], minlength=size)
        return found

    both = summed(training.select("tokens", *labels), sums, (len(labels) + 1, size))
    by_class = np.stack([np.maximum(both[0] - both[1:], 0.0), both[1:]], axis=1) + NB_SMOOTHING
    odds = [math.log(totals[c] / (totals["_rows"] - totals[c])) for c in labels]
    return np.log(by_class / by_class.sum(axis=2, keepdims=True)), np.array(odds)


@dataclass
class ToxicityModel:
    """A trained classifier. ``skipped`` lists labels that had only one class.

    ``tables[label, class, term]`` are log probabilities for naive Bayes; for a regression, zero
    and the coefficients. ``training`` tells what each label was trained on.
    """

    model_type: str
    tfidf: TfidfModel
    labels: list[str]
    tables: np.ndarray
    intercepts: np.ndarray
    skipped: list[str] = field(default_factory=list)
    cleaning: Cleaning = field(default_factory=Cleaning)
    training: list[dict] = field(default_factory=list)
    is_trained = True

    def coefficients(self, label: str) -> np.ndarray:
        """The weight of each term for a label."""
        clean, toxic = self.tables[self.labels.index(label)]
        return toxic - clean

    def probabilities(self, df: DataFrame, tokens: Column, prefix: str = "_p_") -> DataFrame:
        """Append the probability of every label, by one sparse product per batch of texts."""
        weights = self.tables[:, 1] - self.tables[:, 0]
        sums = self.tfidf.weighted_sums(tokens, df.sparkSession, weights)
        df = df.withColumn("_sums", sums)
        return df.withColumns({
            prefix + label: 1 / (1 + F.exp(-(F.get("_sums", F.lit(i)) + float(self.intercepts[i]))))
            for i, label in enumerate(self.labels)}).drop("_sums")

    def predict(self, df: DataFrame, text_col: str = "text",
                threshold: float = THRESHOLD) -> DataFrame:
        """Append ``is_toxic, confidence, labels, detected_types, clean_text``; no shuffle."""
        cleaned = computed_once(self.cleaning.apply(df, text_col),
                                {"clean_text": F.col("clean_text")})
        scored = self.probabilities(cleaned, token_text(F.col("clean_text")))
        scored = computed_once(scored, {f"_p_{c}": F.col(f"_p_{c}") for c in self.labels})
        raw = {label: F.col(f"_p_{label}") for label in self.labels}
        scored = scored.withColumn("labels", F.create_map(*[
            x for label, p in raw.items() for x in (F.lit(label), numbers.round_exact(p, 4))]))
        scored = scored.withColumn("detected_types", F.array_compact(F.array(*[
            F.when(p >= threshold, F.lit(label)) for label, p in raw.items()])))
        return (scored.withColumn("is_toxic", F.size("detected_types") > 0)
                .withColumn("confidence", F.array_max(F.map_values("labels")))
                .drop(*[f"_p_{label}" for label in self.labels]))

    def outcomes(self, df: DataFrame, id_col: str, tokens: Column) -> DataFrame:
        """``id, label, actual, predicted`` rows at the models' own cut."""
        scored = self.probabilities(df, tokens)
        rows = F.array(*[F.struct(F.lit(label).alias("label"),
                                  F.col(label).cast("int").alias("actual"),
                                  (F.col(f"_p_{label}") > DECISION).cast("int").alias("predicted"))
                         for label in self.labels])
        return rows_of(scored, [id_col], rows, "label")

    def feature_importance(self, spark: SparkSession, label: str = "toxic",
                           top_n: int = 20) -> DataFrame:
        """``word, importance``: the terms with the highest coefficients."""
        if label not in self.labels:
            raise ValueError(f"no model for {label!r}; trained were {self.labels}")
        if self.model_type != "logistic_regression":
            raise ValueError(f"a {self.model_type} model has no coefficients to rank terms by")
        every = pa.table([pa.array(self.tfidf.terms, pa.string()),
                          pa.array(self.coefficients(label))], names=["word", "importance"])
        return spark.createDataFrame(every).orderBy(F.desc("importance"), "word").limit(top_n)

    def training_table(self, spark: SparkSession) -> DataFrame:
        """``label, rows, positives, vocabulary, gradient`` of the labels trained."""
        rows = [(c["label"], c["rows"], c["positives"], len(self.tfidf.terms), c["gradient"])
                for c in self.training]
        return spark.createDataFrame(
            rows, "label string, rows long, positives long, vocabulary long, gradient double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write weights, vocabulary and settings below ``path``, replacing what is there."""
        n, _, size = self.tables.shape
        weights = pa.table(
            [pa.array(np.repeat(self.labels, size)), pa.array(np.tile(np.arange(size), n), pa.int32()),
             pa.array(self.tables[:, 0].ravel()), pa.array(self.tables[:, 1].ravel())],
            names=["label", "idx", "clean", "toxic"])
        spark.createDataFrame(weights).write.mode("overwrite").parquet(f"{path}/weights")
        self.tfidf.table(spark).write.mode("overwrite").parquet(f"{path}/vocabulary")
        settings = {"model_type": self.model_type, "labels": self.labels,
                    "intercepts": self.intercepts.tolist(), "skipped": self.skipped,
                    "training": self.training, "ngrams": list(self.tfidf.ngrams),
                    "remove_stops": self.cleaning.remove_stops,
                    "lemmas": self.cleaning.lemmas is not None}
        self.cleaning.save(f"{path}/lemmas")
        spark.createDataFrame([(json.dumps(settings),)], "settings string") \
             .write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ToxicityModel":
        settings = json.loads(spark.read.parquet(f"{path}/settings").first().settings)
        # Bounded by the vocabulary size.
        vocabulary = spark.read.parquet(f"{path}/vocabulary").toArrow().sort_by("idx")
        tfidf = TfidfModel(vocabulary["term"].to_pylist(), vocabulary["idf"].to_pylist(),
                           tuple(settings["ngrams"]))
        weights = spark.read.parquet(f"{path}/weights").toArrow()
        tables = np.zeros((len(settings["labels"]), 2, len(tfidf.terms)))
        for i, label in enumerate(settings["labels"]):
            own = weights.filter(pc.equal(weights["label"], label)).sort_by("idx")
            tables[i] = own["clean"].to_numpy(), own["toxic"].to_numpy()
        cleaning = Cleaning.load(spark, f"{path}/lemmas", settings["remove_stops"],
                                 settings["lemmas"])
        return cls(settings["model_type"], tfidf, settings["labels"], tables,
                   np.array(settings["intercepts"]), settings["skipped"], cleaning,
                   settings["training"])


def train(df: DataFrame, id_col: str = "id", text_col: str = "comment_text",
          model_type: str = "logistic_regression", test_size: float = 0.2, seed: int = 42,
          labels: list[str] | None = None, remove_stops: bool = False,
          lemmas: DataFrame | None = None, **vectorizer) -> tuple[ToxicityModel, DataFrame]:
    """Train one model per label column; returns the model and its metrics per label.

    The tokens of the texts are computed once and written to the shared folder, since every step
    reads them; they are deleted at the end. ``remove_stops`` and ``lemmas`` (``form, lemma``)
    belong to the cleaning and are kept with the model. Rows without an id take part like others.
    Labels with a single class in the training part cannot be learned; they are skipped and
    listed in ``skipped``.
    """
    _check_type(model_type)
    labels = labels or discover_labels(df)
    spark = df.sparkSession
    cleaning = Cleaning(remove_stops, lemmas)
    corpus = cleaning.apply(in_parts(df, text_col).select(
        id_col, text_col, *[F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in labels],
        in_test_part(id_col, test_size, seed, (text_col,)).alias("_test")), text_col)
    corpus = corpus.withColumn("tokens", token_text(F.col("clean_text"))) \
                   .select(id_col, *labels, "_test", "tokens")
    with stored(corpus, "corpus") as corpus:
        training = corpus.filter("NOT _test")
        totals = training.agg(F.count("*").alias("_rows"),
                              *[F.sum(c).alias(c) for c in labels]).first().asDict()
        rows = totals["_rows"]
        learnable = [c for c in labels if 0 < (totals[c] or 0) < rows]
        if not learnable:
            raise ValueError(f"no label has two classes: {labels}")
        tfidf = TfidfModel.fit_tokens(training, "tokens", texts=rows, **vectorizer)
        gradients = [None] * len(learnable)
        if model_type == "naive_bayes":
            tables, intercepts = fit_naive_bayes(training, learnable, tfidf, totals)
        else:
            with regression.blocks(training, learnable, tfidf) as blocks:
                found, gradients = regression.minimize(blocks, len(tfidf.terms), rows,
                                                       [totals[c] for c in learnable])
            tables = np.stack([np.zeros_like(found[:, :-1]), found[:, :-1]], axis=1)
            intercepts = found[:, -1]
        model = ToxicityModel(
            model_type, tfidf, learnable, tables, intercepts,
            [c for c in labels if c not in learnable], cleaning,
            [{"label": c, "rows": rows, "positives": totals[c], "gradient": g}
             for c, g in zip(learnable, gradients)])
        measured = binary_metrics(model.outcomes(corpus.filter("_test"), id_col, F.col("tokens")))
        metrics = measured.collect()  # a row per label
    return model, spark.createDataFrame(metrics, measured.schema)


def gradient_sizes(model: ToxicityModel, df: DataFrame, id_col: str = "id",
                   text_col: str = "comment_text", test_size: float = 0.2,
                   seed: int = 42) -> DataFrame:
    """How far a trained logistic regression is from the minimum of what it minimizes.

    Per label ``rows, positives, vocabulary`` and ``gradient``: the largest entry of the
    gradient of half the squared norm plus the class-balanced log loss, over all training rows.
    """
    labels = model.labels
    kept = df.select(id_col, text_col, *[F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c)
                                         for c in labels])
    rows = kept.filter(~in_test_part(id_col, test_size, seed, (text_col,)))
    tokens = model.cleaning.apply(rows, text_col).withColumn(
        "tokens", token_text(F.col("clean_text"))).select(*labels, "tokens")
    totals = rows.agg(F.count("*").alias("rows"), *[F.sum(c).alias(c) for c in labels]).first()
    points = np.column_stack([model.tables[:, 1], model.intercepts])
    with regression.blocks(tokens, labels, model.tfidf) as blocks:
        _, gradients = regression.value_and_gradient(
            blocks, dict(enumerate(points)), totals["rows"], [totals[c] for c in labels])
    return df.sparkSession.createDataFrame(
        [(c, totals["rows"], totals[c], len(model.tfidf.terms), float(abs(g).max()))
         for c, g in zip(labels, gradients)],
        "label string, rows long, positives long, vocabulary long, gradient double")


def prediction_table(predictions: DataFrame, text_col: str = "text", *keep: str) -> DataFrame:
    """The readable prediction table: clipped text, verdict, confidence, first two types."""
    types = F.array_join(F.slice("detected_types", 1, 2), ", ")
    return predictions.select(
        *keep, F.substring(text_col, 1, 44).alias("Text"),
        F.when(F.col("is_toxic"), "🔴 YES").otherwise("🟢 NO").alias("Toxic"),
        numbers.percent_text(F.col("confidence")).alias("Conf"),
        F.when(types == "", "-").otherwise(types).alias("Types"))

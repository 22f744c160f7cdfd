"""Lemma lookup for cleaned text, and the whole cleaning chain for classifiers.

The lemma dictionary is data the caller brings as a table ``form, lemma``. Without one,
every form is its own lemma.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from civiltext.functions import text as txt
from civiltext.functions.barrier import computed_once, elements_of
from civiltext.operators.broadcasts import is_small, lookup_join
from civiltext.operators.termcodes import pieces


def _changes(lemmas: DataFrame) -> DataFrame:
    """``_form, _lemma``: forms whose (shortest, then first) lemma is another word."""
    best = lemmas.groupBy("form").agg(F.min(F.struct(F.length("lemma").alias("n"), "lemma"))
                                      .alias("best"))
    return best.select(F.col("form").alias("_form"), F.col("best.lemma").alias("_lemma")) \
               .filter("_form <> _lemma")


def lemmatize(df: DataFrame, clean_col: str, lemmas: DataFrame | None,
              out: str = "clean_text") -> DataFrame:
    """Replace every token of ``clean_col`` by its lemma; appends ``out``.

    With a dictionary of checked size this happens in the row. With a larger one, tokens are
    looked up by a salted join and come back grouped by the text they stand in, which its
    digest names: equal texts are one group, and ids play no part.
    """
    if lemmas is None:
        return df.withColumn(out, F.col(clean_col))
    changes = _changes(lemmas)
    if is_small(changes, ["_form", "_lemma"]):
        # Bounded by the check.
        return df.withColumn(out, _in_row({r._form: r._lemma for r in changes.collect()})(clean_col))
    keyed = df.withColumn("_key", F.md5(F.col(clean_col).cast("binary")))
    tokens = elements_of(keyed, ["_key"], F.split(clean_col, " "), "_pos", "_form")
    found = lookup_join(tokens, changes, "_form", spread=F.struct("_key", "_pos"))
    per_text = found.groupBy("_key").agg(
        F.map_from_entries(F.collect_set(F.struct("_pos", "_lemma"))).alias("_new"))
    lemma_at = F.transform(F.split(clean_col, " "),
                           lambda w, i: F.coalesce(F.element_at(F.col("_new"), i), w))
    return (keyed.join(per_text, "_key", "left")
            .withColumn(out, F.when(F.col("_new").isNull(), F.col(clean_col))
                        .otherwise(F.array_join(lemma_at, " ")))
            .drop("_key", "_new"))


def _in_row(table: dict[str, str]):
    """A column function that replaces the tokens found in ``table``."""
    known = table.get

    def replace(texts: pa.Array) -> pa.Array:
        # Piece by piece: a batch has as many texts as Spark likes, however long they are.
        made = [pa.array([t if t is None else " ".join([known(w, w) for w in t.split(" ")])
                          for t in piece.to_pylist()], pa.string()) for piece in pieces(texts)]
        return pa.concat_arrays(made) if made else texts

    replace.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(replace, returnType="string")


@dataclass
class Cleaning:
    """What turns a text into the form a classifier works on."""

    remove_stops: bool = False
    lemmas: DataFrame | None = None

    def apply(self, df: DataFrame, text_col: str, out: str = "clean_text") -> DataFrame:
        cleaned = txt.preprocess(F.col(text_col), remove_stops=self.remove_stops)
        if self.lemmas is None:
            return df.withColumn(out, cleaned)
        cleaned_once = computed_once(df, {out: cleaned})
        return lemmatize(cleaned_once.withColumnRenamed(out, "_cleaned"), "_cleaned", self.lemmas,
                         out).drop("_cleaned")

    def save(self, path: str) -> None:
        if self.lemmas is not None:
            self.lemmas.select("form", "lemma").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, remove_stops: bool, has_lemmas: bool) -> "Cleaning":
        return cls(remove_stops, spark.read.parquet(path) if has_lemmas else None)


# Endings of English plural nouns and what they are replaced by.
NOUN_ENDINGS = [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
                ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")]


def _with_ending_replaced(word: Column) -> Column:
    return F.array_compact(F.array(*[
        F.when(word.endswith(old), F.concat(F.left(word, F.length(word) - len(old)), F.lit(new)))
        for old, new in NOUN_ENDINGS]))


def _candidates(form: Column) -> Column:
    """All words ``form`` may be a plural of, as ``lvl, size, n, lemma``: the form itself, the form
    with an ending replaced, and so on; at most as many rounds as the form has letters."""
    kind = "array<struct<lvl:int,size:int,n:int,lemma:string>>"
    own = F.struct(F.lit(1).alias("lvl"), F.length(form).alias("size"), F.lit(0).alias("n"),
                   form.alias("lemma"))
    start = F.struct(F.array(form).alias("level"), F.array(own).cast(kind).alias("every"))

    def step(state: Column, lvl: Column) -> Column:
        made = F.flatten(F.transform(state["level"], _with_ending_replaced))
        listed = F.transform(made, lambda w, i: F.struct(
            lvl.alias("lvl"), F.length(w).alias("size"),
            F.when(lvl == 1, i + 1).otherwise(1).cast("int").alias("n"), w.alias("lemma")))
        return F.struct(F.array_distinct(made).alias("level"),
                        F.concat(state["every"], listed.cast(kind)).alias("every"))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(form), F.lit(1))), start, step,
                       lambda state: state["every"])


def noun_lemmas(forms: DataFrame, nouns: DataFrame,
                exceptions: DataFrame | None = None) -> DataFrame:
    """A lemma table ``form, lemma`` for the words in ``forms`` (column ``form``).

    A lemma is the shortest candidate that is a known noun: the form itself, or the form
    with a plural ending replaced. If none is known, endings are replaced again. A form
    listed in ``exceptions`` (``form, lemma``) takes its candidates from there. Forms
    without any known noun are left out. Candidates are made in the form's own row, so one
    join with the nouns is all there is.
    """
    forms = forms.select("form").distinct()
    nouns = nouns.select(F.col("noun").alias("lemma")).distinct()
    regular = forms
    if exceptions is not None:
        listed = exceptions.select("form", "lemma").distinct()
        irregular = forms.join(listed.select("form").distinct(), "form", "left_semi")
        regular = forms.join(irregular, "form", "left_anti")
    candidates = regular.select("form", F.inline(_candidates(F.col("form"))))
    if exceptions is not None:
        both = (irregular.select("form", F.lit(0).alias("n"), F.col("form").alias("lemma"))
                .unionByName(listed.join(irregular, "form", "left_semi")
                             .select("form", F.lit(1).alias("n"), "lemma")))
        candidates = candidates.unionByName(both.select(
            "form", F.lit(1).alias("lvl"), F.length("lemma").alias("size"), "n", "lemma"))
    return (candidates.join(nouns, "lemma").groupBy("form")
            .agg(F.min(F.struct("lvl", "size", "n", "lemma")).alias("best"))
            .select("form", F.col("best.lemma").alias("lemma")))

"""Every operator as a query over the given tables.

The tables hold few modifiers and no phrases, so some queries work on *remarks*: the
documents with common words swapped for others (``SWAPS``), which brings phrases,
intensifiers, negations, shouting and sentence patterns into texts of every length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from civiltext import tables
from civiltext.functions import text as txt
from civiltext.functions.barrier import elements_of
from civiltext.operators import (classifier as clf, detection as det, exploration as ex,
                                 features as ft, lemmas as lm, lexicon as lx, rewriting as rw,
                                 sampling as sm)
from civiltext.plans import analysis as an
from civiltext.sources import corpus as cp
from civiltext.sources.shared import cut_lineage, in_parts, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Word swaps that turn documents into remarks, applied in order.
SWAPS = [(" are ", " piss off "), (" with ", " totally stupid "), (" from ", " not "),
         (" this ", " you are so "), (" by ", " I HATE "), (" at ", " never the awful "),
         (" was ", " end you "), (" as ", " wtf!!! "), (" on ", " i "), (" que ", " go to hell "),
         (" und ", " very "), (" des ", " screw you "), (" les ", " get lost "),
         (" er ", " I'll kill "), (" el ", " fuck-off, (Asshole) ")]
# Swaps that bring sentence patterns into conversations.
SENTENCE_SWAPS = [(" de ", " you're STUPID "), (" that ", " i hate you "), (" die ", " go away "),
                  (" la ", " I will hurt you "), (" to ", " you're an idiot ")]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def swapped(text: Column, swaps: list[tuple[str, str]]) -> Column:
    for old, new in swaps:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return cp.read_texts(spark, f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def remarks(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).withColumn("text", swapped(F.col("text"), SWAPS))


def remarks_in_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The remarks, dealt evenly: for what takes long per text."""
    docs = in_parts(documents(spark, sf), "text")
    return docs.withColumn("text", swapped(F.col("text"), SWAPS))


def talk(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").withColumn(
        "text", swapped(F.col("text"), SENTENCE_SWAPS))


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", "html")


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with texts missing (German) or blank (French)."""
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.when(F.col("lang") == "de", F.lit(None))
                       .when(F.col("lang") == "fr", F.lit(" \t\n")).otherwise(F.col("text"))
                       .alias("text"))


def labeled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that ``labels`` covers, with six labels; all but ``toxic`` come from words."""
    low = F.lower("text")

    def has(word: str) -> Column:
        return F.contains(low, F.lit(word)).cast("int")

    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    return documents(spark, sf).join(labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("comment_text"), "toxic",
        (F.col("toxic") * has("idiot")).alias("severe_toxic"), has("moron").alias("obscene"),
        has("threaten").alias("threat"), has("stupid").alias("insult"),
        has("disgusting").alias("identity_hate"))


def joined(array: Column | str) -> Column:
    return F.array_join(array, " ")


def changes_text(changes: str = "changes_made") -> Column:
    return F.array_join(F.transform(changes, lambda c: F.concat(c.old, F.lit("=>"), c.new)), "|")


HIT_FIELDS = ["word", "category", "position", "is_phrase", "has_intensifier", "is_negated"]


# --- sources and sinks ---------------------------------------------------------------------

@query
def scan_labeled_csv(spark, sf):
    path = scratch_path(spark, "labeled-csv")
    cp.write_labeled_csv(labeled(spark, sf), path)
    return cp.read_labeled_csv(spark, path)


@query
def lines_to_rows(spark, sf):
    return an.lines_to_rows(documents(spark, sf))


@query
def demo_corpus(spark, sf):
    """As many demonstration comments as there are documents, twice over."""
    return cp.demo_corpus(spark, 2 * documents(spark, sf).count())


@query
def demo_rows(spark, sf):
    """The demonstration comments whose numbers are those of the documents."""
    numbers = documents(spark, sf).select(F.col("doc_id").alias("i"))
    return sm.concat_rows(cp.demo_rows(numbers, toxic=True), cp.demo_rows(numbers, toxic=False)) \
        .select("i", "comment_text", "toxic")


@query
def demo_labels(spark, sf):
    numbers = documents(spark, sf).select(F.col("doc_id").alias("i"))
    return cp.demo_rows(numbers, toxic=True).select("i", *tables.LABELS)


@query
def batch_report_sink(spark, sf):
    path = scratch_path(spark, "report")
    cp.write_report(an.batch_report(an.analyze(remarks_in_parts(spark, sf)), "doc_id"), path, "json")
    return spark.read.schema("doc_id bigint, Text string, Status string, Confidence string, "
                             "Types string, Neutralized string").json(path)


# --- projections, filters, guards ----------------------------------------------------------

@query
def null_to_empty(spark, sf):
    return gappy(spark, sf).select("doc_id", txt.null_to_empty(F.col("text")).alias("text"))


@query
def blank_guard(spark, sf):
    blank = an.analyze(gappy(spark, sf)).filter(txt.is_blank(F.col("text")))
    return blank.select("doc_id", "original_text", "clean_text", "highlighted_text",
                        "neutral_text", F.col("is_toxic").cast("int").alias("is_toxic"),
                        "confidence", "intensity_score", "toxic_count",
                        F.size("toxic_words").alias("hits"), F.size("changes_made").alias("changes"))


@query
def blank_guard_neutralize(spark, sf):
    blank = rw.neutralize(gappy(spark, sf)).filter(txt.is_blank(F.col("text")))
    return blank.select("doc_id", "neutral_text", "strategy_used", "neutralization_score",
                        F.size("changes_made").alias("changes"))


@query
def label_discovery(spark, sf):
    df = labeled(spark, sf).drop("obscene").withColumn("note", F.lit(0))
    found = ex.discover_labels(df)
    listed = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(c).alias("label"),
                                F.col(c).alias("flag")) for i, c in enumerate(found)])
    return (df.select(F.inline(listed)).groupBy("ord", "label")
            .agg(F.count("*").alias("labeled_rows"), F.sum("flag").alias("positives")))


@query
def filter_by_label(spark, sf):
    return ex.filter_by_label(labeled(spark, sf)).select("id", "toxic")


@query
def text_metrics(spark, sf):
    text = F.col("text")
    return documents(spark, sf).select("doc_id", txt.char_count(text).alias("chars"),
                                       txt.word_count(text).alias("words"))


@query
def batch_report(spark, sf):
    return an.batch_report(an.analyze(documents(spark, sf)), "doc_id")


@query
def change_log_view(spark, sf):
    out = rw.neutralize(talk(spark, sf))
    shown = rw.short_changes(F.col("changes_made"))
    return out.select("conv_id", "turn", F.size("changes_made").alias("changes"),
                      F.size(shown).alias("shown"))


# --- text cleaning -------------------------------------------------------------------------

def cleaned(spark, sf, fn) -> DataFrame:
    return documents(spark, sf).select("doc_id", fn(F.col("text")).alias("out"))


def cleaned_pages(spark, sf, fn) -> DataFrame:
    return pages(spark, sf).select("page_id", fn(F.col("html")).alias("out"))


@query
def lowercase(spark, sf):
    return cleaned(spark, sf, txt.lowercase)


@query
def strip_urls(spark, sf):
    return cleaned_pages(spark, sf, txt.strip_urls)


@query
def strip_html(spark, sf):
    return cleaned_pages(spark, sf, txt.strip_html)


@query
def keep_letters(spark, sf):
    return cleaned(spark, sf, txt.keep_letters)


@query
def strip_punct(spark, sf):
    return cleaned(spark, sf, txt.strip_punct)


def spoken(spark, sf) -> DataFrame:
    """Cleaned documents with words the tokenizer splits."""
    swaps = [(" the ", " cannot "), (" of ", " gonna "), (" and ", " wanna "), (" la ", " gimme ")]
    return documents(spark, sf).select("doc_id", txt.keep_letters(F.lower(
        swapped(F.col("text"), swaps))).alias("clean"))


@query
def tokenize(spark, sf):
    return elements_of(spoken(spark, sf), ["doc_id"], txt.tokenize(F.col("clean")), "position",
                       "token")


@query
def drop_stopwords(spark, sf):
    return spoken(spark, sf).select(
        "doc_id", joined(txt.drop_stopwords(txt.tokenize(F.col("clean")))).alias("out"))


def lemmatized(spark, sf, df: DataFrame) -> DataFrame:
    """``clean`` with the plurals of nouns from benchmark texts replaced."""
    docs = df.withColumn("clean", txt.preprocess(F.col("text")))
    forms = docs.select(F.explode(F.split("clean", " ")).alias("form")).filter("form <> ''")
    nouns = table(spark, sf, "benchmark").select(
        F.explode(F.split(txt.preprocess(F.col("text")), " ")).alias("noun")).filter("noun <> ''")
    return lm.lemmatize(docs, "clean", lm.noun_lemmas(forms, nouns), "out")


@query
def lemmatize(spark, sf):
    return lemmatized(spark, sf, documents(spark, sf)).select("doc_id", "out")


@query
def lemmatize_talk(spark, sf):
    """Conversations, whose ids repeat."""
    return lemmatized(spark, sf, talk(spark, sf)).select("conv_id", "turn", "out")


def short_lemmas(spark, sf) -> DataFrame:
    """A lemma table: long words of benchmark texts are forms of their first letters."""
    words = table(spark, sf, "benchmark").select(
        F.explode(F.split(txt.preprocess(F.col("text")), " ")).alias("form"))
    return words.filter(F.length("form") > 6).distinct().select(
        "form", F.substring("form", 1, 4).alias("lemma"))


@query
def preprocess_lemmas(spark, sf):
    """The whole cleaning chain with stopwords removed and lemmas looked up."""
    cleaning = lm.Cleaning(remove_stops=True, lemmas=short_lemmas(spark, sf))
    return cleaning.apply(documents(spark, sf), "text", "out").select("doc_id", "out")


@query
def preprocess_model(spark, sf):
    return cleaned_pages(spark, sf, txt.preprocess)


@query
def preprocess_light(spark, sf):
    return cleaned_pages(spark, sf, lambda c: txt.preprocess(c, for_model=False))


@query
def preprocess_batch(spark, sf):
    return txt.preprocess_table(gappy(spark, sf), "text").select("doc_id", "clean_text")


# --- detection -----------------------------------------------------------------------------

@query
def lexicon_table(spark, sf):
    """Every term with its category, and how many documents have it as a token."""
    lexicon = lx.Lexicon.default()
    listed = F.array(*[F.lit(t) for t in lexicon.terms])
    # At most one row per text and term leaves a text, and as many rows as terms a task.
    docs_with = (det.split_texts(documents(spark, sf), [], "text")
                 .select(F.explode(F.array_intersect("_words", listed)).alias("term"))
                 .groupBy("term").agg(F.count("*").alias("docs")))
    return (lexicon.table(spark).join(F.broadcast(docs_with), "term", "left")
            .select("term", "category", "is_phrase", "ord",
                    F.coalesce("docs", F.lit(0)).alias("docs")))


@query
def lexicon_extend(spark, sf):
    """Hits with a lexicon extended by the words of part names, by join."""
    words = (table(spark, sf, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("term"))
             .unionByName(table(spark, sf, "benchmark").select(
                 F.explode(txt.words_lower(F.col("text"))).alias("term")))
             .filter("term <> ''").distinct()
             .select("term", F.lit("custom").alias("category"), F.lit(0).alias("ord")))
    lex = lx.combine_listings(lx.Lexicon.default().listing_table(spark), words)
    hits = det.token_hits_by_join(documents(spark, sf), "doc_id", lex)
    return hits.groupBy("word", "category").agg(F.count("*").alias("hits"))


@query
def lexicon_terms(spark, sf):
    """All terms, with the number of remarks that contain the term anywhere."""
    low = remarks(spark, sf).select(F.lower("text").alias("low"))
    terms = lx.Lexicon.default().terms
    counts = low.agg(*[F.count_if(F.contains("low", F.lit(t))).alias(f"t{i}")
                       for i, t in enumerate(terms)])
    named = F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"t{i}").alias("texts"))
                      for i, t in enumerate(terms)])
    return counts.select(F.inline(named))


@query
def lexicon_summary(spark, sf):
    """Terms per category, and hits per category in remarks."""
    hits = (det.detect(remarks_in_parts(spark, sf)).select(F.inline("toxic_words"))
            .groupBy("category").agg(F.count("*").alias("hits")))
    summary = lx.terms_per_category(lx.Lexicon.default().table(spark))
    return summary.join(F.broadcast(hits), "category", "left") \
                  .select("category", "terms", F.coalesce("hits", F.lit(0)).alias("hits"))


@query
def phrase_hits(spark, sf):
    out = det.detect(remarks(spark, sf)).select("doc_id", F.inline("toxic_words"))
    return out.filter("is_phrase").select("doc_id", "word", "category", "position")


@query
def phrase_hits_by_join(spark, sf):
    lex = lx.Lexicon.default().table(spark)
    return det.phrase_hits_by_join(remarks(spark, sf), "doc_id", lex) \
              .select("doc_id", "word", "category", "position")


@query
def tokenize_ws(spark, sf):
    return elements_of(documents(spark, sf), ["doc_id"], txt.words_lower(F.col("text")),
                       "position", "token")


@query
def token_normalize(spark, sf):
    return det.token_table(documents(spark, sf), "doc_id").select("doc_id", "position", "word")


def hits_of(spark, sf, *columns) -> DataFrame:
    return (det.detect(remarks(spark, sf)).select("doc_id", F.inline("toxic_words"))
            .filter("NOT is_phrase").select("doc_id", "position", *columns))


@query
def token_hits(spark, sf):
    return (det.detect(documents(spark, sf)).select("doc_id", F.inline("toxic_words"))
            .filter("NOT is_phrase").select("doc_id", "position", "word", "category"))


@query
def token_hits_by_join(spark, sf):
    return det.token_hits_by_join(remarks(spark, sf), "doc_id", lx.Lexicon.default().table(spark))


@query
def hit_intensifier(spark, sf):
    return hits_of(spark, sf, "word", "has_intensifier")


@query
def hit_negation(spark, sf):
    return hits_of(spark, sf, "word", "is_negated")


@query
def toxic_count(spark, sf):
    return det.detect(remarks(spark, sf)).select("doc_id", "toxic_count")


@query
def categories_found(spark, sf):
    return det.detect(remarks(spark, sf)).select(
        "doc_id", joined("categories_found").alias("categories"))


@query
def non_toxic_words(spark, sf):
    return det.detect(remarks(spark, sf)).select("doc_id", joined("non_toxic_words").alias("words"))


@query
def intensity_score(spark, sf):
    return det.detect(remarks(spark, sf)).select("doc_id", "intensity_score")


@query
def highlight(spark, sf):
    return det.detect(remarks(spark, sf)).select("doc_id", "highlighted_text")


def long_words(spark, sf) -> DataFrame:
    """The words of ten characters or more in the documents."""
    # The outer form: for the plain one Spark adds a filter that cleans every text two times more.
    return det.split_texts(documents(spark, sf), [], "text").select(
        F.explode_outer("_words").alias("term")).filter(F.length("term") >= 10).distinct()


@query
def detect_large_lexicon(spark, sf):
    """Verdicts by a lexicon of many thousand terms, two short phrases among them."""
    words = long_words(spark, sf)
    more = words.select("term", F.lit("custom").alias("category"), F.lit(0).alias("ord"))
    phrases = spark.createDataFrame([("a ", "custom", 0), ("of th", "custom", 0),
                                     ("é d", "custom", 0)], "term string, category string, ord int")
    lex = lx.combine_listings(lx.Lexicon.default().listing_table(spark), more.unionByName(phrases))
    texts = cut_lineage(remarks(spark, sf))  # read for their size, their words and to be judged
    out = an.lexicon_verdict(det.detect_table(texts, lex))
    return out.select("doc_id", F.col("is_toxic").cast("int").alias("is_toxic"), "confidence",
                      joined("toxicity_types").alias("types"), "toxic_count", "intensity_score",
                      joined(F.transform("toxic_words", lambda h: h.word)).alias("hit_words"),
                      "highlighted_text", joined("non_toxic_words").alias("other_words"))


@query
def detect(spark, sf):
    return det.detect(documents(spark, sf)).select(
        "doc_id", "toxic_count", joined("categories_found").alias("categories"),
        "intensity_score", joined(F.transform("toxic_words", lambda h: h.word)).alias("hit_words"),
        F.size("non_toxic_words").alias("other_words"))


# --- neutralization ------------------------------------------------------------------------

@query
def sentence_rewrite(spark, sf):
    return talk(spark, sf).select("conv_id", "turn", rw.sentence_rewrite("text").alias("sentence"))


@query
def word_replacement(spark, sf):
    out = rw.replace_words(remarks(spark, sf), "text", "out", "changes_made")
    return out.select("doc_id", "out", changes_text().alias("changes"))


@query
def word_replacement_table(spark, sf):
    """Replacements from a table of tens of thousands: long words lose their last letter, again
    and again while what is left is a term."""
    words = long_words(spark, sf)
    listed = words.select("term", F.expr("left(term, length(term) - 1)").alias("neutral"),
                          F.col("term").alias("ord"))
    texts = cut_lineage(remarks(spark, sf))  # read for their size, their words and to be rewritten
    out = rw.replace_words(texts, "text", "out", "changes_made", rw.Wording(table=listed))
    return out.select("doc_id", "out", changes_text().alias("changes"))


@query
def phrase_rules(spark, sf):
    out = rw.phrase_rules(remarks(spark, sf), "text", "out", "changes_made")
    return out.select("doc_id", "out", changes_text().alias("changes"))


@query
def title_case_runs(spark, sf):
    return remarks(spark, sf).select("doc_id", rw.title_case_runs(F.col("text")).alias("out"))


@query
def final_cleanup(spark, sf):
    return rw.final_cleanup(remarks(spark, sf), "text", "out").select("doc_id", "out")


@query
def neutralization_score(spark, sf):
    return rw.neutralize(remarks(spark, sf)).select("doc_id", "neutralization_score")


@query
def neutralize(spark, sf):
    return rw.neutralize(remarks_in_parts(spark, sf)).select(
        "doc_id", "neutral_text", "strategy_used", changes_text().alias("changes"))


@query
def strategy_switch(spark, sf):
    texts = cut_lineage(remarks(spark, sf))  # every strategy reads them
    parts = [rw.neutralize(texts, strategy=s).select(
        F.lit(s).alias("strategy"), F.length("neutral_text").alias("chars"),
        F.size("changes_made").alias("changes")) for s in rw.STRATEGIES]
    return sm.concat_rows(*parts).groupBy("strategy").agg(
        F.count("*").alias("texts"), F.sum("chars").alias("chars"),
        F.sum("changes").alias("changes"))


@query
def batch_neutralize(spark, sf):
    out = rw.neutralize(talk(spark, sf))
    return out.select("conv_id", "turn", "neutral_text", "strategy_used", "neutralization_score")


@query
def neutralize_text(spark, sf):
    return rw.neutralize_text("text", documents(spark, sf))


@query
def replacement_extend(spark, sf):
    wording = rw.Wording().add_replacement("The", "A").add_replacement("of and", "off")
    out = rw.replace_words(remarks(spark, sf), "text", "out", "changes_made", wording)
    return out.select("doc_id", "out")


@query
def replacement_order(spark, sf):
    """Application order over a replacement table made from customer segments and part types."""
    words = (table(spark, sf, "part").select(F.lower("p_type").alias("term"))
             .unionByName(table(spark, sf, "customer").select(F.lower("c_mktsegment").alias("term")))
             .groupBy("term").agg(F.count("*").alias("uses")))
    listed = words.select("term", F.upper("term").alias("neutral"),
                          F.struct(-F.col("uses"), "term").alias("ord"))
    return lx.replacement_order(listed).select("term", "step")


# --- analysis and report -------------------------------------------------------------------

def analysis_row(df: DataFrame, *keys) -> DataFrame:
    return df.select(*keys, F.col("is_toxic").cast("int").alias("is_toxic"), "confidence",
                     joined("toxicity_types").alias("types"), "toxic_count", "intensity_score")


@query
def analyze_lexicon(spark, sf):
    return analysis_row(an.analyze(remarks(spark, sf)), "doc_id")


@query
def conditional_neutralize(spark, sf):
    out = an.analyze(documents(spark, sf))
    return out.select("doc_id", F.col("is_toxic").cast("int").alias("is_toxic"), "neutral_text",
                      F.size("changes_made").alias("changes"))


@query
def analyze(spark, sf):
    out = an.analyze(documents(spark, sf))
    return out.select("doc_id", "original_text", "clean_text",
                      F.col("is_toxic").cast("int").alias("is_toxic"), "confidence",
                      joined("toxicity_types").alias("types"), "toxic_count", "intensity_score",
                      joined(F.transform("toxic_words", lambda h: h.word)).alias("hit_words"),
                      "highlighted_text", "neutral_text", changes_text().alias("changes"))


@query
def batch_analyze(spark, sf):
    return analysis_row(an.batch_analyze(talk(spark, sf)), "conv_id", "turn", "line_no", "line")


@query
def batch_summary(spark, sf):
    return an.batch_summary(an.analyze(documents(spark, sf)))


@query
def residual_toxicity(spark, sf):
    out = an.residual_toxicity(an.analyze(documents(spark, sf)))
    return out.select("doc_id", "toxic_count", "residual_count")


# --- corpus statistics ---------------------------------------------------------------------

@query
def corpus_stats(spark, sf):
    return ex.corpus_stats(documents(spark, sf), "text")


@query
def label_distribution(spark, sf):
    return ex.label_distribution(labeled(spark, sf))


@query
def label_count(spark, sf):
    df = labeled(spark, sf)
    return df.select("id", ex.label_count(ex.discover_labels(df)).alias("label_count"))


@query
def multilabel_stats(spark, sf):
    return ex.multilabel_stats(labeled(spark, sf))


@query
def clean_toxic_split(spark, sf):
    return ex.clean_toxic_split(labeled(spark, sf))


def verdicts(spark, sf) -> DataFrame:
    """The lexicon's verdict against every label."""
    judged = det.detect(labeled(spark, sf), "comment_text")
    rows = F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("actual"),
                              (F.col("toxic_count") > 0).cast("int").alias("predicted"))
                     for c in tables.LABELS])
    return judged.select(F.inline(rows))


@query
def binary_metrics(spark, sf):
    return ex.binary_metrics(verdicts(spark, sf))


@query
def macro_average(spark, sf):
    return ex.macro_average(ex.binary_metrics(verdicts(spark, sf)))


@query
def evaluation_report(spark, sf):
    return ex.evaluation_report(ex.binary_metrics(verdicts(spark, sf)))


# --- sampling ------------------------------------------------------------------------------

def without_some_ids(df: DataFrame) -> DataFrame:
    """Every third row loses its id."""
    return df.withColumn("id", F.when(F.col("id").cast("long") % 3 != 0, F.col("id")))


def sample_size(df: DataFrame) -> int:
    """Half of the rows, so that there is something to leave out at every size."""
    return df.count() // 2


@query
def balanced_sample(spark, sf):
    df = without_some_ids(labeled(spark, sf)).select("id", "toxic")
    return sm.balanced_sample(df, "id", size=sample_size(df))


@query
def concat_rows(spark, sf):
    df = labeled(spark, sf).select("id", "toxic", "insult")
    return sm.concat_rows(ex.filter_by_label(df, 1), ex.filter_by_label(df, 0, "insult"))


@query
def shuffle_rows(spark, sf):
    shuffled = sm.shuffle_rows(labeled(spark, sf).select("id"), "id")
    return shuffled.select("id", sm.shuffle_key("id").alias("sort_key"))


@query
def train_test_split(spark, sf):
    train, test = sm.train_test_split(without_some_ids(labeled(spark, sf)), "id")
    return sm.concat_rows(train.select("id", F.lit("train").alias("part")),
                          test.select("id", F.lit("test").alias("part")))


# --- features ------------------------------------------------------------------------------

def clean_documents(spark, sf) -> DataFrame:
    return documents(spark, sf).select("doc_id", txt.preprocess(F.col("text")).alias("clean_text"))


@query
def term_tokens(spark, sf):
    return clean_documents(spark, sf).select(
        "doc_id", joined(ft.term_tokens(F.col("clean_text"))).alias("tokens"))


@query
def strip_accents(spark, sf):
    return cleaned(spark, sf, txt.strip_accents)


@query
def ngrams_1_2(spark, sf):
    terms = ft.with_terms(clean_documents(spark, sf), "clean_text")
    return elements_of(terms, ["doc_id"], F.col("terms"), "position", "term")


def document_tokens(spark, sf) -> DataFrame:
    """Ids and tokens of all documents, computed once."""
    docs = in_parts(documents(spark, sf), "text")
    return cut_lineage(docs.select("doc_id", txt.preprocess(F.col("text")).alias("clean_text")).select(
        "doc_id", ft.token_text(F.col("clean_text")).alias("tokens")))


@query
def df_pruning(spark, sf):
    docs = document_tokens(spark, sf)
    return ft.prune(ft.frequent_counts(docs, "tokens"), docs.count())


@query
def vocab_top_k(spark, sf):
    return ft.vocabulary(cut_lineage(df_pruning(spark, sf)))


@query
def tfidf(spark, sf):
    docs = document_tokens(spark, sf)
    weights = ft.TfidfModel.fit_tokens(docs, "tokens").token_weights(docs, "doc_id", "tokens")
    return weights.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query
def doc_vectors(spark, sf):
    docs = document_tokens(spark, sf)
    model = ft.TfidfModel.fit_tokens(docs, "tokens")
    v = docs.select("doc_id", F.unwrap_udt(model.vector(F.col("tokens"), spark)).alias("v"))
    return v.select("doc_id", F.size("v.indices").alias("entries"),
                    F.round(F.aggregate("v.values", F.lit(0.0), lambda s, x: s + x * x), 6)
                    .alias("squared_length"))


# --- models --------------------------------------------------------------------------------

def naive_bayes(spark, sf, **options) -> clf.ToxicityModel:
    """A model for all labels; ``threat`` may have one class only and is then skipped."""
    return clf.train(labeled(spark, sf), model_type="naive_bayes", **options)[0]


def probability_columns(predictions: DataFrame, *keys) -> DataFrame:
    return predictions.select(*keys, F.col("is_toxic").cast("int").alias("is_toxic"), "confidence",
                              *[F.try_element_at("labels", F.lit(c)).alias(f"p_{c}")
                                for c in tables.LABELS], joined("detected_types").alias("types"))


TOLERANCE = 0.02  # largest gradient entry at which a regression counts as solved


def solved(model: clf.ToxicityModel, spark: SparkSession) -> DataFrame:
    """What every label's regression was trained on, and whether it is at its minimum."""
    return model.training_table(spark).withColumn(
        "solved", (F.col("gradient") < TOLERANCE).cast("int")).drop("gradient")


def measured(spark, sf, **options) -> DataFrame:
    """The metrics of every label on the texts held out, beside what it was trained on."""
    model, metrics = clf.train(labeled(spark, sf), **options)
    return metrics.join(solved(model, spark), "label")


@query
def train_lr(spark, sf):
    return measured(spark, sf)


@query
def train(spark, sf):
    """Logistic regression on texts without stopwords, with lemmas."""
    return measured(spark, sf, remove_stops=True, lemmas=short_lemmas(spark, sf))


@query
def train_lr_minimum(spark, sf):
    """Whether every regression is at the minimum of its objective over all training rows."""
    return solved(clf.train(labeled(spark, sf))[0], spark)


@query
def train_minimum(spark, sf):
    """The same for texts without stopwords, with lemmas."""
    return solved(clf.train(labeled(spark, sf), remove_stops=True,
                            lemmas=short_lemmas(spark, sf))[0], spark)


@query
def train_nb(spark, sf):
    return clf.train(labeled(spark, sf), model_type="naive_bayes")[1]


@query
def train_nb_lemmas(spark, sf):
    return clf.train(labeled(spark, sf), model_type="naive_bayes", remove_stops=True,
                     lemmas=short_lemmas(spark, sf))[1]


@query
def predict(spark, sf):
    return probability_columns(naive_bayes(spark, sf).predict(documents(spark, sf)), "doc_id")


@query
def predict_lemmas(spark, sf):
    """A model with stopwords and lemmas, saved and loaded, on documents."""
    path = scratch_path(spark, "model")
    naive_bayes(spark, sf, remove_stops=True, lemmas=short_lemmas(spark, sf)).save(spark, path)
    model = clf.ToxicityModel.load(spark, path)
    return probability_columns(model.predict(documents(spark, sf)), "doc_id")


@query
def predict_batch(spark, sf):
    return probability_columns(naive_bayes(spark, sf).predict(talk(spark, sf)), "conv_id", "turn")


@query
def prediction_table(spark, sf):
    predicted = naive_bayes(spark, sf).predict(documents(spark, sf))
    return clf.prediction_table(predicted, "text", "doc_id")


@query
def analyze_model(spark, sf):
    return analysis_row(an.analyze(in_parts(documents(spark, sf), "text"),
                                   classifier=naive_bayes(spark, sf), threshold=0.5), "doc_id")


@query
def top_features(spark, sf):
    """The terms with the largest coefficients for ``toxic``."""
    model, _ = clf.train(labeled(spark, sf), labels=["toxic"])
    return model.feature_importance(spark, "toxic", 20)


@query
def model_save(spark, sf):
    """The saved vocabulary with its weights, and the saved naive Bayes table for ``toxic``."""
    path = scratch_path(spark, "model")
    naive_bayes(spark, sf).save(spark, path)
    logs = spark.read.parquet(f"{path}/weights").filter("label = 'toxic'")
    return spark.read.parquet(f"{path}/vocabulary").join(logs, "idx").select(
        "idx", "term", F.round("idf", 9).alias("idf"), F.round("clean", 6).alias("clean"),
        F.round("toxic", 6).alias("toxic"))


@query
def model_load(spark, sf):
    """For both kinds of model, texts for which the restored one gives the same probabilities."""
    docs = in_parts(documents(spark, sf), "text")
    parts = []
    for kind in clf.MODEL_TYPES:
        path = scratch_path(spark, "model")
        model, _ = clf.train(labeled(spark, sf), model_type=kind)
        model.save(spark, path)
        again = clf.ToxicityModel.load(spark, path)
        both = again.predict(model.predict(docs).select("text", F.map_values("labels").alias("a")))
        same = F.col("a") == F.map_values("labels")
        parts.append(both.agg(F.lit(kind).alias("model"), F.count("*").alias("texts"),
                              F.count_if(same).alias("equal")))
    return sm.concat_rows(*parts)

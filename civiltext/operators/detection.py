"""Finding toxic words and phrases.

``detect`` is the array form: everything about a text is computed in its own row, so
there is no shuffle. Each row first passes a cheap exact gate (byte scans for phrases, one
prefix-sharing pattern for words); only rows with a hit are split into tokens.

``detect_table`` takes lexicons too large for expressions, as tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Iterator as Batches, Tuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from civiltext import tables
from civiltext.functions import numbers, patterns, sqltext as sql, text as txt
from civiltext.functions.barrier import computed_once, rows_of
from civiltext.operators.blocks import BLOCK, ITEM, beside, block_words, looked_up_arrays, with_blocks
from civiltext.operators.broadcasts import lookup_join
from civiltext.operators.lexicon import Lexicon
from civiltext.operators.lookup import LexiconIndex, Marker, escape_html, fold
from civiltext.sources.shared import cut_lineage

HIT = ("struct<word:string,category:string,position:int,is_phrase:boolean,"
       "has_intensifier:boolean,is_negated:boolean>")
HITS = f"array<{HIT}>"


def has_phrase(low: str, lexicon: Lexicon) -> Column:
    """Whether one of the phrases occurs anywhere in column ``low``, even inside words."""
    return F.expr(sql.any_contained(low, lexicon.phrases))


def phrase_hits(low: str, lexicon: Lexicon) -> Column:
    """One hit per phrase that occurs anywhere in the lower-cased text, even inside words."""
    listed = ", ".join(
        f"named_struct('word', {sql.quote(p)}, 'category', {sql.quote(c)}, 'position', -1, "
        "'is_phrase', true, 'has_intensifier', false, 'is_negated', false)"
        for p, c in lexicon.phrases.items())
    return F.expr(f"filter(cast(array({listed}) AS {HITS}), h -> contains({low}, h.word))")


# Modifier flags of the token at ``i``: the word before it, and the three words before it.
def _intensified(words: str, i: str = "i") -> str:
    return f"coalesce({sql.is_one_of(f'get({words}, {i} - 1)', tables.INTENSIFIERS)}, false)"


def _negated(words: str, i: str = "i") -> str:
    return (f"exists(slice({words}, greatest({i} - 2, 1), least({i}, 3)), "
            f"x -> {sql.is_one_of('x', tables.NEGATORS)})")


def token_hits(words: str, lexicon: Lexicon) -> Column:
    """Hits among the normalized tokens in column ``words``."""
    terms = lexicon.words
    return F.expr(
        f"filter(transform({words}, (w, i) -> CASE WHEN {sql.is_one_of('w', terms)} THEN "
        f"named_struct('word', w, 'category', element_at({sql.map_of(terms)}, w), "
        f"'position', i, 'is_phrase', false, 'has_intensifier', {_intensified(words)}, "
        f"'is_negated', {_negated(words)}) END), h -> h IS NOT NULL)")


def raw_intensity(hits: str, tokens: Column) -> Column:
    """Share of hits among tokens, adjusted by modifiers and threats, before rounding."""
    def times(test: str) -> Column:
        return F.expr(f"size(filter({hits}, h -> {test}))")

    score = (F.size(hits) / tokens
             + numbers.repeated_sum(tables.INTENSIFIER_BOOST, times("h.has_intensifier"))
             + numbers.repeated_sum(tables.THREAT_BOOST, times("h.category = 'threat'"))
             - numbers.repeated_sum(tables.NEGATION_DISCOUNT, times("h.is_negated")))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))


def categories_of(hits: Column) -> Column:
    """Distinct categories of hits, sorted."""
    return F.array_sort(F.array_distinct(F.transform(hits, lambda h: h.category)))


def highlight(text: Column, lexicon: Lexicon) -> Column:
    """HTML with every token that is a lexicon word marked, the rest escaped.

    One pass: a token is marked if it consists of a term and surrounding punctuation, so
    marks never nest and a short term never hits the markup of another. The writer's letter
    case is kept. Marks are put in as noncharacters before the text is escaped; the same
    characters in a text are spelled by others meanwhile, so that no text can forge a mark.
    """
    words = lexicon.words
    if not words:
        return _escape_html(text)
    junk = f"[^{patterns.WORD}{patterns.SPACE}]*"
    token = (f"(?iu)(?<![^{patterns.SPACE}])({junk})({patterns.any_of(words)})({junk})"
             f"(?![^{patterns.SPACE}])")
    spelled = _replaced(text, _SPELLED)
    marked = F.regexp_replace(spelled, token, f"$1{_OPEN}$2{_CLOSE}$3")
    marks = [(_OPEN, tables.MARK_OPEN), (_CLOSE, tables.MARK_CLOSE)]
    back = [(spelling, char) for char, spelling in reversed(_SPELLED)]
    return _replaced(_escape_html(marked), marks + back)


# Noncharacters: they are part of no word, so spelling one by others changes no token.
_OPEN, _CLOSE, _ESCAPE = "\ufdd0", "\ufdd1", "\ufdd2"
_SPELLED = [(_ESCAPE, _ESCAPE + "\ufdd3"), (_OPEN, _ESCAPE + "\ufdd4"),
            (_CLOSE, _ESCAPE + "\ufdd5")]


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _escape_html(text: Column) -> Column:
    return _replaced(text, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")])


def detect(df: DataFrame, text_col: str = "text",
           lexicon: Lexicon | None = None) -> DataFrame:
    """Append detection columns to ``df``.

    ``toxic_words`` (hits: phrases in lexicon order, then tokens by position),
    ``toxic_count``, ``categories_found``, ``highlighted_text``, ``intensity_score`` and
    ``non_toxic_words``. Columns that are not selected later are not computed.
    """
    lexicon = lexicon or Lexicon.default()
    lexicon.check_inline()
    own = ["_text", "_low", "_hit", "_flat"]
    text, hit = F.col("_text"), F.col("_hit")
    staged = (
        df.withColumn("_text", txt.null_to_empty(F.col(text_col)))
        .withColumn("_low", F.lower(text))
        .withColumn("_squeezed", txt.squeeze(F.col("_low")))
        .withColumn("_hit", has_phrase("_low", lexicon)
                    | txt.has_whole_token("_squeezed", list(lexicon.words)))
        # From here on, null stands for "no hit" and every function passes it through.
        .withColumn("_flat", F.when(hit, txt.collapse_space(F.col("_low"))))
        .withColumn("_words", F.split(F.regexp_replace("_flat", f"[^{patterns.WORD} ]+", ""), " "))
        .withColumn("toxic_words", F.when(hit, F.concat(
            phrase_hits("_low", lexicon), token_hits("_words", lexicon)))
            .otherwise(F.expr(f"cast(array() AS {HITS})")))
        .withColumn("_raw", F.when(hit, raw_intensity("toxic_words", F.size("_words"))))
    )
    staged = computed_once(staged, {
        "_hit": hit, "_flat": F.col("_flat"), "toxic_words": F.col("toxic_words"),
        "intensity_score": F.when(hit, numbers.round_exact(F.col("_raw"), 3))
                            .otherwise(F.lit(0.0))}, "_squeezed", "_words", "_raw")
    hits = F.col("toxic_words")
    marked, unmarked = highlight(text, lexicon), _escape_html(text)
    return staged.withColumns({
        "toxic_count": F.size(hits),
        "categories_found": categories_of(hits),
        "highlighted_text": F.when(hit, marked).otherwise(unmarked),
        "non_toxic_words": F.when(
            hit,
            F.filter(F.split("_flat", " "), lambda w, i: ~F.array_contains(
                F.transform(hits, lambda h: h.position), i)))
            .otherwise(txt.words_lower(F.col("_low"))),
    }).drop(*own)


def split_texts(df: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """``keep`` with the raw and the normalized tokens of every non-blank text."""
    flat = txt.collapse_space(F.lower(F.col(text_col)))
    # The test is on the raw text: a filter on the cleaned one would clean it a second time.
    return (df.filter(F.col(text_col).rlike(f"[^{patterns.SPACE}]"))
            .select(*keep, flat.alias("_flat"))
            .select(*keep, F.split("_flat", " ").alias("_tokens"),
                    F.split(F.regexp_replace("_flat", f"[^{patterns.WORD} ]+", ""), " ")
                    .alias("_words")))


def token_table(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """One row per token: id, ``position``, ``token`` and normalized ``word``."""
    row = ("transform(_words, (w, i) -> named_struct('position', i, 'token', get(_tokens, i), "
           "'word', w))")
    return rows_of(split_texts(df, [id_col], text_col), [id_col], F.expr(row), "position")


def token_hits_by_join(df: DataFrame, id_col: str, lexicon: DataFrame,
                       text_col: str = "text") -> DataFrame:
    """Token hits as rows, for a lexicon given as a table of any size.

    A lexicon that was counted and found small is looked up in the text's own row, so that only
    hits become rows. For a larger one every token becomes a row, with the three words before it,
    and is joined with the lexicon.
    """
    return _token_hits(df, [id_col], lexicon, text_col)


def _token_hits(df: DataFrame, keep: list[str], lexicon: DataFrame, text_col: str) -> DataFrame:
    terms = (lexicon.filter(~F.col("is_phrase"))
             .select(F.col("term").alias("word"), "category"))
    if _fits(terms, "word"):
        rows = terms.toArrow()
        index = LexiconIndex(rows["word"].to_pylist(), rows["category"].to_pylist(),
                             [False] * len(rows))
        flat = F.coalesce(txt.collapse_space(F.lower(F.col(text_col))), F.lit(""))
        norm = F.regexp_replace(flat, f"[^{patterns.WORD} ]+", "")
        found = StructType([
            *(df.schema[c] for c in keep), StructField("word", StringType()),
            StructField("category", StringType()), StructField("position", IntegerType()),
            StructField("has_intensifier", BooleanType()), StructField("is_negated", BooleanType())])
        sent = df.sparkSession.sparkContext.broadcast(index)
        hits = df.select(*keep, norm.alias("_norm")).mapInArrow(
            lambda batches: _hit_rows(batches, sent.value, found.names), found)
        return hits.select(*keep, "word", "category", "position", F.lit(False).alias("is_phrase"),
                           "has_intensifier", "is_negated")
    texts = split_texts(df, keep, text_col).select(*keep, "_words")
    tokens = texts.select(*keep, "_words", F.posexplode_outer("_words").alias("position", "word")) \
                  .filter(F.col("word").isNotNull())
    three = F.slice("_words", F.greatest(F.col("position") - 2, F.lit(1)),
                    F.least(F.col("position"), F.lit(3)))
    found = lookup_join(tokens.select(*keep, "position", "word", three.alias("_before")), terms,
                        "word", spread=F.struct(*keep, "position"))
    return found.select(
        *keep, "word", "category", "position", F.lit(False).alias("is_phrase"),
        F.expr(f"coalesce({sql.is_one_of('try_element_at(_before, -1)', tables.INTENSIFIERS)}, "
               "false)").alias("has_intensifier"),
        F.expr(f"exists(_before, x -> {sql.is_one_of('x', tables.NEGATORS)})").alias("is_negated"))


HITS_AT_ONCE = 50_000   # rows that a task makes before it hands them on, or the hits of one text


def _hit_rows(batches: Iterator[pa.RecordBatch], index: LexiconIndex,
              names: list[str]) -> Iterator[pa.RecordBatch]:
    """A row per hit from rows whose last column is the normalized text."""
    strong, negators = set(tables.INTENSIFIERS), set(tables.NEGATORS)
    for batch in batches:
        kept, texts, rows = batch.columns[:-1], batch.columns[-1], []

        def made() -> pa.RecordBatch:
            row, number, at, has, is_negated = list(zip(*rows)) or [()] * 5
            return pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(row, pa.int64())) for c in kept), *_named(index, number),
                 pa.array(at, pa.int32()), pa.array(has, pa.bool_()),
                 pa.array(is_negated, pa.bool_())], names=names)

        for row in range(batch.num_rows):
            text = texts[row].as_py()
            if own := index.words_in(text):
                words = text.split(" ")
                rows += [(row, number, at, at > 0 and words[at - 1] in strong,
                          not negators.isdisjoint(words[max(0, at - 3):at])) for at, number in own]
            if len(rows) >= HITS_AT_ONCE:
                yield made()
                rows = []
        if rows:
            yield made()


AUTOMATON_BYTES = 4 << 20   # of phrases in one automaton; its nodes take some fifty times that


def phrase_hits_by_join(df: DataFrame, id_col: str, lexicon: DataFrame,
                        text_col: str = "text") -> DataFrame:
    """Phrase hits as rows, for a lexicon given as a table of any size.

    One automaton finds all phrases in a text at once. Phrases beyond ``AUTOMATON_BYTES`` are
    spread over several automata, each of which reads the texts. Only hits leave a text's row.
    """
    return _phrase_hits(df, [id_col], lexicon, text_col)


def _phrase_hits(df: DataFrame, keep: list[str], lexicon: DataFrame, text_col: str) -> DataFrame:
    phrases = cut_lineage(lexicon.filter(F.col("is_phrase") & (F.col("term") != ""))
                          .select("term", "category"))
    octets = phrases.agg(F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()[0]
    blocks = max(1, -(-octets // AUTOMATON_BYTES))
    number = F.pmod(F.xxhash64("term"), F.lit(blocks))
    low = F.lower(txt.null_to_empty(F.col(text_col)))
    found = None
    for i in range(blocks):
        rows = phrases.filter(number == i).toArrow()
        index = LexiconIndex(rows["term"].to_pylist(), rows["category"].to_pylist(),
                             [True] * len(rows))
        hits = df.select(*keep, F.explode_outer(_phrase_finder(df, index)(low)).alias("_h")) \
                 .filter("_h IS NOT NULL")
        found = hits if found is None else found.unionByName(hits)
    no = F.lit(False)
    return found.select(*keep, "_h.word", "_h.category", F.lit(-1).alias("position"),
                        F.lit(True).alias("is_phrase"), no.alias("has_intensifier"),
                        no.alias("is_negated"))


def _lists(found: list[list], arrays: list[pa.Array], names: list[str]) -> pa.ListArray:
    """Structs in lists, one list per text."""
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                    pa.StructArray.from_arrays(arrays, names))


def _named(index: LexiconIndex, numbers: list[int]) -> list[pa.Array]:
    return [pa.array([index.terms[i] for i in numbers], pa.string()),
            pa.array([index.categories[i] for i in numbers], pa.string())]


def _phrase_finder(df: DataFrame, index: LexiconIndex):
    sent = df.sparkSession.sparkContext.broadcast(index)

    def find(low: pa.Array) -> pa.Array:
        found = [sent.value.phrases_in(t) for t in low.to_pylist()]
        return _lists(found, _named(sent.value, [i for f in found for i in f]),
                      ["word", "category"])

    find.__annotations__ = {"low": pa.Array, "return": pa.Array}
    return F.arrow_udf(find, returnType="array<struct<word:string,category:string>>")


def detect_by_join(df: DataFrame, id_col: str, lexicon: DataFrame,
                   text_col: str = "text") -> DataFrame:
    """All hits as rows (id and hit fields); same hits as ``detect`` has in ``toxic_words``."""
    return token_hits_by_join(df, id_col, lexicon, text_col).unionByName(
        phrase_hits_by_join(df, id_col, lexicon, text_col))


MAX_INDEX_ROWS = 500_000
MAX_INDEX_BYTES = 16 << 20


def _fits(lexicon: DataFrame, term_col: str) -> bool:
    """Whether a lexicon may be sent to the tasks, by counting at most one row too many."""
    rows, octets = lexicon.limit(MAX_INDEX_ROWS + 1).agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length(term_col)), F.lit(0))).first()
    return rows <= MAX_INDEX_ROWS and octets <= MAX_INDEX_BYTES


def detect_table(df: DataFrame, lexicon: DataFrame, text_col: str = "text") -> DataFrame:
    """``detect`` for a lexicon given as a table (``term, category, is_phrase, ord``) of any size.

    Appends the same columns. A lexicon that was counted and found within ``MAX_INDEX_ROWS`` and
    ``MAX_INDEX_BYTES`` is sent to the tasks, and everything about a text is found in its own row.
    Of a larger one, each block of texts gets the terms that its words lead to, and the texts are
    looked up where these stand; ids may be missing or repeated.
    """
    lexicon = cut_lineage(lexicon.select("term", "category", "is_phrase", "ord"))
    if _fits(lexicon, "term"):
        return _detect_in_row(df, lexicon, text_col)
    return _detect_by_blocks(df, lexicon, text_col)


def _staged(df: DataFrame, text_col: str) -> DataFrame:
    """With the text, lower-cased, with single blanks, and without what belongs to no word."""
    staged = df.withColumn("_text", txt.null_to_empty(F.col(text_col)))
    staged = staged.withColumn("_low", F.lower("_text"))
    staged = staged.withColumn("_flat", txt.collapse_space(F.col("_low")))
    return computed_once(staged, {"_low": F.col("_low"), "_flat": F.col("_flat"),
                                  "_norm": F.regexp_replace("_flat", f"[^{patterns.WORD} ]+", "")})


_FOUND = "tokens:array<struct<word:string,category:string,position:int>>,marked:string,kept:array<boolean>"


def _found(tokens: list[list[tuple]], marked: list, norms: list) -> list[pa.Array]:
    """Columns of ``_FOUND`` from the hits ``word, category, position`` of each text; ``kept``
    tells of every token whether it is none."""
    flat = [hit for own in tokens for hit in own]
    ends = np.cumsum([0, *(0 if n is None else n.count(" ") + 1 for n in norms)])
    kept = np.ones(ends[-1], bool)
    kept[[start + at for start, own in zip(ends.tolist(), tokens) for _, _, at in own]] = False
    return [_lists(tokens, [pa.array([w for w, _, _ in flat], pa.string()),
                            pa.array([c for _, c, _ in flat], pa.string()),
                            pa.array([at for _, _, at in flat], pa.int32())],
                   ["word", "category", "position"]),
            pa.array(marked, pa.string()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(kept))]


def _completed(staged: DataFrame) -> DataFrame:
    """What follows from ``_phrases``, ``_found``, ``_flat`` and ``_norm``."""
    phrases = F.expr("transform(_phrases, p -> named_struct('word', p.word, 'category', "
                     "p.category, 'position', -1, 'is_phrase', true, 'has_intensifier', false, "
                     "'is_negated', false))")
    tokens = F.expr(
        "transform(_found.tokens, t -> named_struct('word', t.word, 'category', t.category, "
        "'position', t.position, 'is_phrase', false, "
        f"'has_intensifier', {_intensified('_words', 't.position')}, "
        f"'is_negated', {_negated('_words', 't.position')}))")
    staged = staged.withColumn("_words", F.split("_norm", " "))
    staged = computed_once(staged, {
        "toxic_words": F.concat(phrases, tokens).cast(HITS), "_n": F.size("_words"),
        "highlighted_text": F.col("_found.marked"), "_kept": F.col("_found.kept")},
        "_words", "_norm", "_found", "_phrases")
    hits, hit = F.col("toxic_words"), F.size("toxic_words") > 0
    staged = staged.withColumn("_raw", F.when(hit, raw_intensity("toxic_words", F.col("_n"))))
    return staged.withColumns({
        "toxic_count": F.size(hits),
        "categories_found": categories_of(hits),
        "intensity_score": F.coalesce(numbers.round_exact(F.col("_raw"), 3), F.lit(0.0)),
        "non_toxic_words": F.when(F.col("_flat") == "", F.array().cast("array<string>")).otherwise(
            F.filter(F.split("_flat", " "), lambda w, i: F.get(F.col("_kept"), i))),
    }).drop("_raw", "_text", "_low", "_flat", "_n", "_kept")


def _detect_in_row(df: DataFrame, lexicon: DataFrame, text_col: str) -> DataFrame:
    rows = lexicon.orderBy("ord").select("term", "category", "is_phrase").toArrow()
    sent = df.sparkSession.sparkContext.broadcast(
        LexiconIndex(*(rows[c].to_pylist() for c in ("term", "category", "is_phrase"))))

    def look_up(text: pa.Array, low: pa.Array, words: pa.Array) -> pa.Array:
        index, norms = sent.value, words.to_pylist()
        phrases = [index.phrases_in(t) for t in low.to_pylist()]
        tokens = [[(index.terms[i], index.categories[i], at) for at, i in index.words_in(t)]
                  for t in norms]
        marked = [index.marker.mark(t, index.folded) if p or w else escape_html(t)
                  for t, p, w in zip(text.to_pylist(), phrases, tokens)]
        return pa.StructArray.from_arrays(
            [_lists(phrases, _named(index, [i for f in phrases for i in f]), ["word", "category"]),
             *_found(tokens, marked, norms)], ["phrases", "tokens", "marked", "kept"])

    look_up.__annotations__ = {"text": pa.Array, "low": pa.Array, "words": pa.Array,
                               "return": pa.Array}
    finder = F.arrow_udf(look_up, returnType="struct<phrases:array<struct<word:string,"
                         f"category:string>>,{_FOUND}>")
    staged = _staged(df, text_col).withColumn("_found", finder("_text", "_low", "_norm"))
    return _completed(staged.withColumn("_phrases", F.col("_found.phrases")))


def _detect_by_blocks(df: DataFrame, lexicon: DataFrame, text_col: str) -> DataFrame:
    words = lexicon.filter(~F.col("is_phrase"))
    marks = words.filter(F.col("term") != "").select(_folded(F.col("term")).alias("first")).distinct()
    edges = f"^[^{patterns.WORD}]|[^{patterns.WORD}]\\z"
    marker = Marker(marks.filter(F.col("first").rlike(edges)).agg(
        F.coalesce(F.max(F.length("first")), F.lit(0))).first()[0])
    # What a token may be, and what a stretch of one without letter case may be.
    keys = words.select(F.col("term").alias("first"), "category", F.lit(True).alias("is_word"),
                        F.lit(False).alias("is_mark")).unionByName(
        marks.select("first", F.lit(None).cast("string").alias("category"),
                     F.lit(False).alias("is_word"), F.lit(True).alias("is_mark")))
    keys = keys.groupBy("first").agg(*(F.max(c).alias(c) for c in ("category", "is_word", "is_mark")))

    def in_text(text: str, norm: str) -> set[str]:
        return {*norm.split(" "), *marker.all_candidates(text)}

    def finding(listed: list[dict]) -> Callable:
        known = {r["first"]: r["category"] for r in listed if r["is_word"]}
        marks = {r["first"] for r in listed if r["is_mark"]}

        def find(text: str, norm: str, has_phrase: bool) -> tuple[list, str, str]:
            hits = [(w, known[w], at) for at, w in enumerate(norm.split(" ")) if w in known]
            marked = marker.mark(text, marks) if hits or has_phrase else escape_html(text)
            return hits, marked, norm
        return find

    def struct(done: list) -> pa.Array:
        hits, marked, norms = zip(*(d or ([], None, None) for d in done)) if done else [()] * 3
        return pa.StructArray.from_arrays(_found(hits, marked, norms), ["tokens", "marked", "kept"])

    def look_up(batches):
        yield from looked_up_arrays(batches, finding, struct)

    look_up.__annotations__ = {"batches": Batches[Tuple[pa.Array, ...]], "return": Batches[pa.Array]}
    # It goes by the order of the rows: nothing may be moved past it.
    finder = F.arrow_udf(look_up, returnType=f"struct<{_FOUND}>").asNondeterministic()
    texts, blocks = with_blocks(df, text_col)
    listed = block_words(_staged(texts, text_col), ["_text", "_norm"], in_text)
    staged = _staged(beside(texts, listed.join(keys, "first"), blocks), text_col)
    staged = staged.withColumn("_phrases", _phrases_of(df.sparkSession, F.col("_low"), lexicon))
    staged = staged.withColumn("_found", finder(BLOCK, ITEM, "_text", "_norm", F.size("_phrases") > 0))
    return _completed(staged.filter(F.col(ITEM).isNull()).drop(BLOCK, ITEM))


def _folded(terms: Column) -> Column:
    def folded(terms: pa.Array) -> pa.Array:
        return pa.array([fold(t) for t in terms.to_pylist()], pa.string())

    folded.__annotations__ = {"terms": pa.Array, "return": pa.Array}
    return F.arrow_udf(folded, returnType="string")(terms)


def _phrases_of(spark: SparkSession, low: Column, lexicon: DataFrame) -> Column:
    """The phrases that occur anywhere in a lower-cased text, in lexicon order, by as many automata
    as there are ``AUTOMATON_BYTES`` of them."""
    phrases = cut_lineage(lexicon.filter(F.col("is_phrase") & (F.col("term") != ""))
                          .select("term", "category", "ord"))
    octets = phrases.agg(F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()[0]
    automata = max(1, -(-octets // AUTOMATON_BYTES))
    number = F.pmod(F.xxhash64("term"), F.lit(automata))
    kind = f"array<struct<ord:{phrases.schema['ord'].dataType.simpleString()},word:string,category:string>>"
    found = []
    for i in range(automata):
        rows = phrases.filter(number == i).toArrow()
        index = LexiconIndex(rows["term"].to_pylist(), rows["category"].to_pylist(),
                             [True] * len(rows))
        places = pa.array(rows["ord"].to_pylist(), rows.schema.field("ord").type)
        found.append(F.arrow_udf(_ordered_finder(spark.sparkContext.broadcast((index, places))),
                                 returnType=kind)(low))
    return F.array_sort(F.concat(*found))


def _ordered_finder(sent: Broadcast) -> Callable:
    def find(low: pa.Array) -> pa.Array:
        index, places = sent.value
        found = [index.phrases_in(t) for t in low.to_pylist()]
        numbers = [i for f in found for i in f]
        return _lists(found, [places.take(pa.array(numbers, pa.int64())), *_named(index, numbers)],
                      ["ord", "word", "category"])

    find.__annotations__ = {"low": pa.Array, "return": pa.Array}
    return find

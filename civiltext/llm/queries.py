"""One query per operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from civiltext.llm import (byte_bpe, decontamination, jaccard_join, lexical_search, pieces,
                           piecewise, sanitise, secrets, sentence_spans, spelling, token_store,
                           toxicity, warc)
from civiltext.sources.corpus import read_texts
from civiltext.sources.shared import scratch_path


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return read_texts(spark, f"{sf_dir}/{table}.parquet")


def _count(spans: str, kind: str) -> Column:
    of_kind = F.filter(spans, lambda s: s["kind"] == kind)
    return F.size(of_kind).cast("long").alias(f"n_{kind}")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of known form and strings that tokenize badly, in every document."""
    base = secrets.KINDS[:3]
    found = secrets.find_secrets(_read(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), *(_count("spans", k) for k in base),
        F.sha2(secrets.span_text(F.col("spans"), base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"))


def op2_token_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written as entropy-coded segments and read back."""
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(_read(spark, sf_dir, "documents"), path)
    return token_store.read_tokens(spark, path).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op3_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark items, whole or in pieces."""
    found = decontamination.contaminations(_read(spark, sf_dir, "documents"),
                                           _read(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "n_words", "matched", "tiles",
                        "longest", "coverage")


def op4_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learned without the held-out quarter."""
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.train(docs, _read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        F.col("id").alias("doc_id"), (toxicity.fold(F.col("id")) == 2).alias("held_out"), "score",
        (F.col("score") >= toxicity.DECISION).cast("int").alias("predicted"))


def op5_piecewise_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of documents, of their edited texts, and how alike they are."""
    return piecewise.neighbour_likeness(_read(spark, sf_dir, "documents")) \
                    .withColumnRenamed("id", "doc_id")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word sets that overlap by nine tenths; component of each document."""
    found = jaccard_join.jaccard_components(_read(spark, sf_dir, "documents"), n=3,
                                            threshold="0.9")
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op7_disclosure_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of known form, and the terms beside it that give it away."""
    found = sanitise.find_personal_data(_read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != sanitise.TERM)
    return found.select(
        F.col("id").alias("doc_id"), *(_count("spans", k) for k in sanitise.KINDS),
        F.sha2(sanitise.span_text(base), 256).alias("base_sha256"),
        sanitise.span_text(F.col("spans")).alias("spans"))


def op8_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether decoding gives back its text."""
    return pieces.round_trip(_read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as monolithic archives, normalised, and read back by index."""
    path = scratch_path(spark, "warc")
    names = warc.write_monolithic(_read(spark, sf_dir, "pages"), f"{path}/mono")
    warc.normalise(spark, names, f"{path}/mono", f"{path}/members", remove_source=True)
    return warc.read_records(spark, names, f"{path}/members").drop("payload")


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the sentences of passages that stand elsewhere before."""
    return sentence_spans.remove_repeated_spans(_read(spark, sf_dir, "documents")) \
                         .withColumnRenamed("id", "doc_id")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level token ids of every document and the bytes they decode to, as digests."""
    return byte_bpe.round_trip(_read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, how many are one edit away, and the form each is a variant of."""
    return spelling.group_variants(_read(spark, sf_dir, "documents"), damage=199)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for each benchmark item."""
    return lexical_search.search(_read(spark, sf_dir, "documents"),
                                 _read(spark, sf_dir, "benchmark")) \
                         .withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_secret_scan, op2_token_segments, op3_string_tiling, op4_compression_toxicity,
        op5_piecewise_hashing, op6_ngram_jaccard_join, op7_disclosure_sanitisation,
        op8_piece_viterbi, op9_warc_normaliser, op10_sentence_spans, op11_byte_bpe,
        op12_spelling_variants, op13_lexical_search)}

_OP6 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE
      WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1),
                              lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words),
classes AS (
  SELECT min(doc_id) AS id, any_value(s) AS s, len(any_value(s)) AS n
  FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s),
runs AS (SELECT id, n, unnest(s) AS run FROM classes),
pairs AS (
  SELECT a.id AS a, b.id AS b, count(*) AS shared, any_value(a.n) + any_value(b.n) AS total
  FROM runs a JOIN runs b ON a.run = b.run AND a.id < b.id
  WHERE 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n GROUP BY a.id, b.id),
linked AS (SELECT a, b FROM pairs WHERE 100 * shared >= 90 * (total - shared)),
edges AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
reach(id, other) AS (
  SELECT id, id FROM classes
  UNION SELECT r.id, e.b FROM reach r JOIN edges e ON r.other = e.a),
roots AS (SELECT id, min(other) AS root FROM reach GROUP BY id),
members AS (SELECT sets.doc_id, len(sets.s) AS n, classes.id
            FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s)
SELECT m.doc_id, m.n::BIGINT AS n_shingles,
       CASE WHEN m.n = 0 THEN m.doc_id ELSE r.root END AS component_id
FROM members m LEFT JOIN roots r ON m.id = r.id
"""

_OP9 = r"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT hex, min(page_id) AS original FROM payloads GROUP BY hex),
base32 AS (
  SELECT hex, array_to_string(list_transform(
           list_transform(range(32), lambda i:
             (('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31),
           lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v + 1, 1)), '') AS digest
  FROM firsts)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, b.digest AS payload_digest,
       CASE WHEN p.page_id IS NOT DISTINCT FROM f.original THEN 'response' ELSE 'revisit' END
         AS record_type,
       CASE WHEN p.page_id IS DISTINCT FROM f.original THEN f.original END AS refers_to
FROM payloads p JOIN firsts f ON p.hex = f.hex JOIN base32 b ON p.hex = b.hex
"""

# Inside a character class.
_MARKS, _CLOSERS = ".!?。．！？｡…।॥۔؟።།", "\"'')\\]}”’»」』）】"

_OP10 = rf"""
WITH tokens AS (
  SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos, len(t) AS n FROM (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') AS t
    FROM documents)),
words AS (
  SELECT doc_id, pos, token, translate(regexp_extract(token, '^[^\x20\x09-\x0D]+'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word,
    pos = n - 1 OR regexp_matches(token, '[{_MARKS}][{_CLOSERS}]?[\x20\x09-\x0D]*$')
      OR regexp_matches(token, '[\x0A-\x0D]') AS closes FROM tokens),
numbered AS (
  SELECT *, coalesce(sum(closes::INT) OVER (PARTITION BY doc_id ORDER BY pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sid FROM words),
sentences AS (
  SELECT doc_id, sid, count(*) AS n, min(pos) AS first, max(pos) + 1 AS stop,
    string_agg(token, '' ORDER BY pos) AS text FROM numbered GROUP BY ALL),
texts AS (SELECT doc_id, list(word ORDER BY pos) AS w FROM words GROUP BY doc_id),
enough AS (
  SELECT a.doc_id, a.sid AS i, b.sid AS j, a.first, b.stop
  FROM sentences a JOIN sentences b ON a.doc_id = b.doc_id AND b.sid > a.sid AND b.sid < a.sid + 12
  WHERE b.stop - a.first >= 12),
shortest AS (
  SELECT doc_id, i, min(j) AS j, any_value(first) AS first, min(stop) AS stop FROM enough
  GROUP BY doc_id, i
  UNION SELECT doc_id, max(i), j, max(first), any_value(stop) FROM enough GROUP BY doc_id, j
  UNION SELECT doc_id, sid, sid, first, stop FROM sentences
    WHERE n >= 50 OR (n >= 12 AND first = 0 AND stop = (SELECT len(w) FROM texts t
      WHERE t.doc_id = sentences.doc_id))),
runs AS (
  SELECT doc_id, i, j, array_to_string(w[first + 1:stop], ' ') AS run
  FROM shortest JOIN texts USING (doc_id)),
later AS (
  SELECT doc_id, i, j FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS k
    FROM runs) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i::BIGINT, j::BIGINT + 1)) AS sid FROM later),
rest AS (
  SELECT s.doc_id, count(g.sid) AS n_removed, coalesce(sum(s.n) FILTER (g.sid IS NOT NULL), 0)
      AS words_removed, string_agg(s.text, '' ORDER BY s.sid) FILTER (g.sid IS NULL) AS text
  FROM sentences s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.sid = g.sid GROUP BY s.doc_id)
SELECT d.doc_id, CASE WHEN coalesce(n_removed, 0) = 0 THEN coalesce(d.text, '')
    ELSE coalesce(trim(r.text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '') END
    AS text, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(words_removed, 0)::BIGINT AS words_removed
FROM documents d LEFT JOIN rest r ON d.doc_id = r.doc_id
"""

_OP12 = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      range(strlen(s)), lambda i: ('0x' || substr(hex(encode(s)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c // 256, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM runs), steps),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 199 = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
holes AS (
  SELECT DISTINCT word, n, substr(word, 1, i) AS a, substr(word, i + 2) AS b
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b
    ON a.a = b.a AND a.b = b.b AND a.word <> b.word
  UNION SELECT h.word, h.n, w.word, w.n FROM holes h JOIN words w ON h.a || h.b = w.word
  UNION SELECT w.word, w.n, h.word, h.n FROM holes h JOIN words w ON h.a || h.b = w.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form,
    max(other_n) AS form_n, max(other_n) >= 5 * any_value(n) AS enough FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN enough THEN form END AS form,
    CASE WHEN enough THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)),
chains(word, root) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON c.root = f.word
  WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM formed f JOIN chains c ON f.word = c.word JOIN formed e ON c.root = e.word
WHERE e.form IS NULL
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

_OP13 = f"""
WITH docs AS (SELECT doc_id, {_TERMS} AS t FROM documents),
total AS (SELECT count(*) AS n, sum(len(t))::BIGINT AS l FROM docs WHERE len(t) > 0),
asked AS (SELECT item_id, term, count(*) AS q FROM (
  SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
tf AS (SELECT doc_id, term, any_value(n) AS n, count(*) AS tf FROM (
    SELECT doc_id, unnest(t) AS term, len(t) AS n FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(total.n) + 2) / (2 * count(*) + 1)))::BIGINT
  AS w FROM tf, total GROUP BY term),
scores AS (SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf)
    // (1000 * tf + 8 * (25 + (75 * tf.n * total.n) // total.l))))::BIGINT AS score
  FROM tf JOIN weights USING (term) JOIN asked USING (term), total GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT
  AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# The forms of personal data as the query's contract writes them.
_FORMS = [("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
          ("ip", 1, r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
           r"regexp_full_match(v, '(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}')"),
          ("card", 2, r"[0-9](?:[ -]?[0-9])+", "length(digits) BETWEEN 14 AND 19 AND luhn % 10 = 0"),
          ("phone", 3, r"\+[0-9][ ().0-9-]+[0-9]", "length(digits) BETWEEN 10 AND 15")]


def _found(source: str, column: str, keep: str, pattern: str) -> str:
    """Matches of a pattern with their places, from the text between them."""
    return f"""SELECT {keep}, m[k] AS v, (list_sum(list_transform(p[1:k], lambda x: length(x)))
  + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0))::INT AS start
FROM (SELECT {keep}, m, p, unnest(range(1, len(m) + 1)) AS k FROM (SELECT {keep},
  regexp_extract_all({column}, '{pattern}') AS m, regexp_split_to_array({column}, '{pattern}') AS p
  FROM {source}))"""


def _personal_data(support: int, disclosure: float) -> str:
    forms = " UNION ALL ".join(f"""SELECT doc_id, text, start, {number} AS number,
  start + length(v) AS stop, '{kind}' AS kind, CASE WHEN {number} >= 2 THEN digits ELSE lower(v) END
  AS value FROM (SELECT *, regexp_replace(v, '[^0-9]', '', 'g') AS digits,
  list_sum(list_transform(range(length(regexp_replace(v, '[^0-9]', '', 'g'))), lambda i:
    list_sum(list_transform(string_split((string_split(reverse(regexp_replace(v, '[^0-9]', '', 'g')),
    '')[i + 1]::INT * (1 + i % 2))::VARCHAR, ''), lambda d: d::INT)))) AS luhn
  FROM ({_found('docs', 'text', 'doc_id, text', pattern)})) WHERE {valid}"""
                              for kind, number, pattern, valid in _FORMS)
    word = r"\p{L}{3,}"
    return f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
forms AS ({forms}),
mentions AS (SELECT DISTINCT text, kind || ':' || value AS entity FROM forms),
words AS (SELECT DISTINCT text, unnest(regexp_extract_all(lower(text), '{word}')) AS term FROM docs),
named AS (SELECT entity, count(*) AS n FROM mentions GROUP BY entity),
known AS (SELECT term, count(*) AS n FROM words GROUP BY term),
together AS (SELECT entity, term, count(*) AS pairs FROM mentions JOIN words USING (text)
  GROUP BY ALL HAVING count(*) >= {support}),
reveals AS (SELECT entity, term FROM (SELECT entity, term, pairs, known.n AS with_term,
    named.n / (SELECT count(DISTINCT text) FROM docs)::DOUBLE AS share
    FROM together JOIN named USING (entity) JOIN known USING (term))
  WHERE share < 1 AND log2(pairs / with_term::DOUBLE / share) / -log2(share) >= {disclosure}),
places AS ({_found('(SELECT DISTINCT text FROM mentions)', 'text', 'text', word)}),
terms AS (SELECT DISTINCT p.text, start, start + length(v) AS stop FROM places p
  JOIN mentions m ON p.text = m.text JOIN reveals r ON r.entity = m.entity AND r.term = lower(v)),
spans AS (SELECT doc_id, start, number, stop, kind FROM forms UNION
  SELECT doc_id, start, 4, stop, 'term' FROM docs JOIN terms t USING (text) WHERE NOT EXISTS (
    SELECT 1 FROM forms f WHERE f.text = t.text AND f.start < t.stop AND t.start < f.stop)),
joined AS (SELECT doc_id, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number,
    stop) AS spans, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number, stop)
    FILTER (number < 4) AS base, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}"
                                             for k, *_ in _FORMS)} FROM spans GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f'coalesce(n_{k}, 0)::BIGINT AS n_{k}' for k, *_ in _FORMS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN joined j ON d.doc_id = j.doc_id"""


SQL: dict[str, str] = {
    "op6_ngram_jaccard_join": _OP6,
    "op7_disclosure_sanitisation": _personal_data(sanitise.SUPPORT, sanitise.DISCLOSURE),
    "op9_warc_normaliser": _OP9,
    "op10_sentence_spans": _OP10,
    "op12_spelling_variants": _OP12,
    "op13_lexical_search": _OP13,
}

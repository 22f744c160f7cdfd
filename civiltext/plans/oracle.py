"""The same queries as SQL for DuckDB, worked out independently of the Spark plans.

Texts are taken apart into token rows and put together with joins, windows and aggregates,
where the Spark side uses gates, arrays and one-pass patterns.
"""

from __future__ import annotations

from civiltext import tables
from civiltext.operators.classifier import MODEL_TYPES
from civiltext.operators.lemmas import NOUN_ENDINGS
from civiltext.plans.catalog import SENTENCE_SWAPS, SWAPS

W = r"\p{L}\p{N}_"
S = (r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
     r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
PIECES = f"[{W}]+|[^{W}]+"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(expr: str, pattern: str, replacement: str, flags: str = "g") -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(replacement)}, {lit(flags)})"


def nest(expr: str, pairs) -> str:
    for old, new in pairs:
        expr = f"replace({expr}, {lit(old)}, {lit(new)})"
    return expr


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def rows(values) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(
        lit(v) if isinstance(v, str) else str(v) for v in row) + ")" for row in values) + ")"


def rounded(expr: str, digits: int) -> str:
    return f"CAST(format('{{:.{digits}f}}', {expr}) AS DOUBLE)"


# --- inputs --------------------------------------------------------------------------------

DOCUMENTS = "SELECT doc_id, text FROM documents"
REMARKS = f"SELECT doc_id, {nest('text', SWAPS)} AS text FROM documents"
TALK = f"SELECT conv_id, turn, {nest('text', SENTENCE_SWAPS)} AS text FROM conversations"
GAPPY = ("SELECT doc_id, CASE lang WHEN 'de' THEN NULL WHEN 'fr' THEN ' ' || chr(9) || chr(10) "
         "ELSE text END AS text FROM documents")


def _has(word: str) -> str:
    return f"CAST(contains(lower(text), {lit(word)}) AS INT)"


LABELED = f"""SELECT CAST(doc_id AS VARCHAR) AS id, text AS comment_text, toxic,
  toxic * {_has('idiot')} AS severe_toxic, {_has('moron')} AS obscene,
  {_has('threaten')} AS threat, {_has('stupid')} AS insult,
  {_has('disgusting')} AS identity_hate FROM documents JOIN labels USING (doc_id)"""
ALL_LABELS = " + ".join(tables.LABELS)


# --- cleaning ------------------------------------------------------------------------------

def flat(expr: str) -> str:
    return f"trim({sub(expr, f'[{S}]+', ' ')})"


def strip(expr: str) -> str:
    return sub(expr, f"^[{S}]+|[{S}]+$", "")


def letters(expr: str) -> str:
    return flat(sub(expr, f"[^a-zA-Z{S}]", " "))


def untagged(expr: str) -> str:
    return sub(sub(f"lower({expr})", f"https?://[^{S}]+|www\\.[^{S}]+", ""), "<.*?>", "")


def uncontracted(expr: str) -> str:
    for first, second in tables.CONTRACTIONS:
        expr = sub(expr, rf"\b{first}({second})\b", rf"{first} \1")
    return expr


def clean(expr: str) -> str:
    return uncontracted(letters(untagged(f"coalesce({expr}, '')")))


def punct_free(expr: str) -> str:
    return f"translate({expr}, {lit(tables.PUNCTUATION)}, '')"


SPOKEN_SWAPS = [(" the ", " cannot "), (" of ", " gonna "), (" and ", " wanna "),
                (" la ", " gimme ")]
SPOKEN = (f"SELECT doc_id, {uncontracted(letters('lower(' + nest('text', SPOKEN_SWAPS) + ')'))} "
          "AS clean FROM documents")
DROPPED = [w for w in tables.STOPWORDS if w not in tables.KEPT_STOPWORDS]


# --- detection -----------------------------------------------------------------------------

LISTING = [(t, c, i) for i, (t, c) in enumerate(
    (t, c) for c, terms in tables.LEXICON.items() for t in terms)]
CATEGORY = {t: c for t, c, _ in LISTING}
FIRST = {}
for _t, _c, _i in LISTING:
    FIRST.setdefault(_t, _i)
LEXICON = rows([(t, CATEGORY[t], FIRST[t]) for t in CATEGORY])


def token_ctes(source: str, key: str = "doc_id") -> str:
    """``src``, ``arr``, ``toks`` and ``flagged`` for the texts of ``source``."""
    return f"""src AS ({source}),
arr AS (SELECT {key}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[{S}]+'),
  lambda x: x <> '') AS arr FROM src),
toks AS (SELECT {key}, pos, tok, {sub('tok', f'[^{W}]', '')} AS word FROM
  (SELECT {key}, unnest(arr) AS tok, unnest(range(len(arr))) AS pos FROM arr)),
flagged AS (SELECT *, coalesce(lag(word) OVER (PARTITION BY {key} ORDER BY pos)
    IN {in_list(tables.INTENSIFIERS)}, false) AS has_intensifier,
  coalesce(bool_or(word IN {in_list(tables.NEGATORS)}) OVER (PARTITION BY {key} ORDER BY pos
    ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), false) AS is_negated FROM toks)"""


def hit_ctes(source: str, key: str = "doc_id") -> str:
    """``token_ctes`` and ``lex``, ``thits``, ``phits``, ``hits``."""
    return f"""{token_ctes(source, key)},
lex AS (SELECT * FROM {LEXICON} AS l(term, category, ord)),
thits AS (SELECT {key}, word, category, pos AS position, false AS is_phrase, has_intensifier,
  is_negated, 1000 + pos AS rank FROM flagged JOIN lex ON word = term WHERE NOT contains(term, ' ')),
phits AS (SELECT {key}, term AS word, category, -1 AS position, true AS is_phrase,
  false AS has_intensifier, false AS is_negated, ord AS rank
  FROM src JOIN lex ON contains(lower(text), term) WHERE contains(term, ' ')),
hits AS (SELECT * FROM thits UNION ALL SELECT * FROM phits)"""


def steps(step: float, n: str) -> str:
    return (f"list_reduce(list_transform(range({n}), lambda i: {step}::DOUBLE), "
            "lambda a, b: a + b, 0.0::DOUBLE)")


def score_ctes(source: str, key: str = "doc_id") -> str:
    """``hit_ctes`` and ``scored``: one row per text."""
    raw = (f"toxic_count / n::DOUBLE + {steps(tables.INTENSIFIER_BOOST, 'ni')} + "
           f"{steps(tables.THREAT_BOOST, 'nt')} - {steps(tables.NEGATION_DISCOUNT, 'nn')}")
    on = " AND ".join(f"s.{k.strip()} = h.{k.strip()}" for k in key.split(","))
    return f"""{hit_ctes(source, key)},
per_text AS (SELECT {key}, count(*) AS c, count(*) FILTER (has_intensifier) AS ni,
  count(*) FILTER (category = 'threat') AS nt, count(*) FILTER (is_negated) AS nn,
  count(*) FILTER (NOT is_phrase) AS nw,
  string_agg(DISTINCT category, ' ' ORDER BY category) AS types,
  string_agg(word, ' ' ORDER BY rank) AS hit_words FROM hits GROUP BY {key}),
counted AS (SELECT s.*, len(a.arr) AS n, coalesce(c, 0) AS toxic_count, coalesce(ni, 0) AS ni,
  coalesce(nt, 0) AS nt, coalesce(nn, 0) AS nn, coalesce(nw, 0) AS nw,
  coalesce(types, '') AS types, coalesce(hit_words, '') AS hit_words
  FROM src s JOIN arr a USING ({key}) LEFT JOIN per_text h ON {on}),
scored AS (SELECT *, CASE WHEN toxic_count = 0 THEN 0.0::DOUBLE ELSE
  {rounded(f'least(1.0, greatest(0.0, {raw}))', 3)} END AS intensity_score FROM counted)"""


VERDICT = ("CAST(toxic_count > 0 AS INT) AS is_toxic, "
           "least(1.0, intensity_score * 2)::DOUBLE AS confidence, types, toxic_count, "
           "intensity_score")


def escaped(expr: str) -> str:
    return nest(expr, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")])


def core(piece: str, n: int) -> str:
    """The punctuation before a token's word (1), the word (2) and the punctuation after it (3)."""
    return f"regexp_extract({piece}, {lit(f'^([^{W}]*)([{W}]+)([^{W}]*)$')}, {n})"


MARKED = (f"{escaped(core('p', 1))} || {lit(tables.MARK_OPEN)} || {core('p', 2)} || "
          f"{lit(tables.MARK_CLOSE)} || {escaped(core('p', 3))}")


def highlighted(expr: str) -> str:
    words = [t for t in CATEGORY if " " not in t]
    return (f"array_to_string(list_transform(regexp_extract_all({expr}, '[{S}]+|[^{S}]+'), "
            f"lambda p: CASE WHEN lower({core('p', 2)}) IN {in_list(words)} THEN {MARKED} "
            f"ELSE {escaped('p')} END), '')")


# --- rewriting -----------------------------------------------------------------------------

ORDERED = sorted(tables.REPLACEMENTS.items(), key=lambda p: -len(p[0]))


# This dialect has no lookaround and its word boundary knows ASCII letters only, so the
# character before (and after) is matched and put back. Two neighbours share a separator;
# a second round catches the second of them.
BEFORE, AFTER = f"(^|[^{W}])", f"($|[^{W}])"


def word_steps(pairs=ORDERED):
    """Per step: pattern, replacement, rounds, and what the log says."""
    return [(f"(?i){BEFORE}{t}{AFTER}", rf"\1{n}\2", 2, t, n) for t, n in pairs]


def rule_steps():
    out = []
    for pattern, replacement in tables.PHRASE_RULES[:-1]:
        regex = pattern.replace(r"\w", f"[{W}]").replace(r"\s", f"[{S}]")
        new = replacement
        if regex.startswith(r"\b"):
            regex = BEFORE + regex[2:]
            new = r"\1" + replacement.replace(r"\2", r"\3").replace(r"\1", r"\2")
        out.append(("(?i)" + regex, new, 1, pattern, replacement))
    return out


def title_cased(expr: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({expr}, {lit(PIECES)}), lambda t: "
            "CASE WHEN regexp_full_match(t, '[A-Za-z]{2,}') THEN upper(left(t, 1)) || "
            "lower(substr(t, 2)) ELSE t END), '')")


def chain(source: str, todo, title: bool = False) -> str:
    """Apply steps one after the other: the text in ``cur``, and ``log``, ``n``, ``chars``."""
    def step(inner: str, new: str, old: str, wording: str) -> str:
        return (f"SELECT * EXCLUDE (cur, nxt, log, n, chars), nxt AS cur, "
                f"CASE WHEN nxt <> cur THEN log || {lit('|' + old + '=>' + wording)} ELSE log END "
                f"AS log, n + CAST(nxt <> cur AS INT) AS n, "
                f"chars + CASE WHEN nxt <> cur THEN {len(old)} ELSE 0 END AS chars "
                f"FROM (SELECT *, {new} AS nxt FROM ({inner}))")

    sql = f"SELECT *, text AS cur, '' AS log, 0 AS n, 0 AS chars FROM ({source})"
    for pattern, replacement, rounds, old, wording in todo:
        new = "cur"
        for _ in range(rounds):
            new = sub(new, pattern, replacement)
        sql = step(sql, new, old, wording)
    if title:
        old, wording = tables.PHRASE_RULES[-1]
        sql = step(sql, title_cased("cur"), old, wording)
    return sql


def finished(expr: str) -> str:
    """Final cleanup as an expression over ``expr``."""
    one = flat(expr)
    two = f"upper(left({one}, 1)) || substr({one}, 2)"
    three = f"CASE WHEN right({one}, 1) IN ('', '.', '!', '?') THEN {two} ELSE {two} || '.' END"
    return (f"array_to_string(list_transform(regexp_extract_all({three}, {lit(PIECES)}), "
            "lambda t: CASE WHEN t = 'i' THEN 'I' ELSE t END), '')")


SENTENCE = "CASE " + " ".join(
    f"WHEN contains(lower(text), {lit(p)}) THEN {lit(s)}"
    for p, s in tables.SENTENCE_REWRITES.items()) + " ELSE NULL END"


def neutralized(source: str, rules: bool = True) -> str:
    """``neutral_text, strategy_used, neutralization_score, changes, log`` for every text."""
    todo = word_steps() + (rule_steps() if rules else [])
    return f"""SELECT * EXCLUDE (cur, n, chars, sentence, log),
  CASE WHEN sentence IS NOT NULL THEN sentence ELSE {finished('cur')} END AS neutral_text,
  CASE WHEN sentence IS NOT NULL THEN 'sentence_rewrite' WHEN n > 0 THEN 'combined'
    ELSE 'none' END AS strategy_used,
  CASE WHEN sentence IS NOT NULL THEN 1.0::DOUBLE WHEN n = 0 THEN 0.0::DOUBLE
    ELSE {rounded('least(1.0, chars / length(text)::DOUBLE)', 3)} END AS neutralization_score,
  CASE WHEN sentence IS NOT NULL THEN 1 ELSE n END AS changes,
  CASE WHEN sentence IS NOT NULL THEN text || '=>' || sentence ELSE substr(log, 2) END AS log
FROM ({chain(f'SELECT *, {SENTENCE} AS sentence FROM ({source})', todo, title=rules)})"""


def analyzed(source: str, key: str = "doc_id") -> str:
    """CTEs up to ``analysis``: scored texts with rewriting of the toxic ones."""
    return f"""{score_ctes(source, key)},
rewritten AS ({neutralized('SELECT * EXCLUDE (n) FROM scored WHERE toxic_count > 0')}),
analysis AS (SELECT s.* EXCLUDE (n), coalesce(r.neutral_text, s.text) AS neutral_text,
  coalesce(r.changes, 0) AS changes, coalesce(r.log, '') AS log
  FROM scored s LEFT JOIN rewritten r USING ({key}))"""


def clip(expr: str) -> str:
    return f"CASE WHEN length({expr}) > 70 THEN left({expr}, 70) || '...' ELSE {expr} END"


REPORT = f"""SELECT doc_id, {clip('text')} AS "Text",
  CASE WHEN toxic_count > 0 THEN '🔴 Toxic' ELSE '🟢 Clean' END AS "Status",
  format('{{:.0f}}%', least(1.0, intensity_score * 2) * 100) AS "Confidence",
  CASE WHEN types = '' THEN '—' ELSE replace(types, ' ', ', ') END AS "Types",
  {clip('neutral_text')} AS "Neutralized" FROM analysis"""


# --- statistics ----------------------------------------------------------------------------

UNPIVOTED = " UNION ALL ".join(
    f"SELECT {lit(c)} AS label, {c} AS actual, CAST(toxic_count > 0 AS INT) AS predicted "
    "FROM scored" for c in tables.LABELS)
LABELED_TEXT = LABELED.replace("text AS comment_text", "text")


def metric(name: str) -> str:
    tp, fp = "sum(actual * predicted)", "sum((1 - actual) * predicted)"
    fn = "sum(actual * (1 - predicted))"
    p, r = f"({tp} / nullif({tp} + {fp}, 0)::DOUBLE)", f"({tp} / nullif({tp} + {fn}, 0)::DOUBLE)"
    return {"accuracy": "avg(CAST(actual = predicted AS INT))",
            "precision": f"coalesce({p}, 0)::DOUBLE", "recall": f"coalesce({r}, 0)::DOUBLE",
            "f1": f"coalesce(2 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0)::DOUBLE, 0)::DOUBLE"}[name]


METRICS = (f"WITH {score_ctes(LABELED_TEXT, 'id')}, u AS ({UNPIVOTED}), m AS (SELECT label, "
           + ", ".join(f"{metric(m)} AS {m}" for m in ("accuracy", "precision", "recall", "f1"))
           + " FROM u GROUP BY label)")
SORT_KEY = "md5('42:' || id)"


# --- features ------------------------------------------------------------------------------

# Expects ``c`` (doc_id, clean_text, test): the texts, of which those not in ``test`` are fitted on.
TERM_CTES = """uni AS (SELECT doc_id, unnest(t) AS term, unnest(range(len(t))) AS position, len(t) AS n FROM
  (SELECT doc_id, list_filter(string_split(clean_text, ' '), lambda x: length(x) >= 2) AS t FROM c)),
pairs AS (SELECT doc_id, term || ' ' || lead(term) OVER (PARTITION BY doc_id ORDER BY position)
  AS term, position + n AS position FROM uni),
terms AS (SELECT doc_id, term, position FROM uni UNION ALL
  SELECT * FROM pairs WHERE term IS NOT NULL),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
counts AS (SELECT term, sum(tf)::BIGINT AS tf, count(*) AS df FROM tf JOIN c USING (doc_id)
  WHERE NOT test GROUP BY term),
total AS (SELECT count(*) AS n FROM c WHERE NOT test),
pruned AS (SELECT counts.* FROM counts, total WHERE df >= 3 AND df <= 0.9 * n),
vocab AS (SELECT * FROM pruned ORDER BY tf DESC, term LIMIT 500000),
raw AS (SELECT doc_id, term, (1 + ln(tf.tf)) * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w
  FROM tf JOIN vocab USING (term), total),
weights AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""
TERMS = (f"c AS (SELECT doc_id, {clean('text')} AS clean_text, false AS test FROM documents), "
         + TERM_CTES)

LEMMA_TABLE = (f"SELECT DISTINCT form, left(form, 4) AS lemma FROM (SELECT unnest(string_split("
               f"{clean('text')}, ' ')) AS form FROM benchmark) WHERE length(form) > 6")


def with_lemmas(source: str, key: str, text: str) -> str:
    """``key, clean_text``: cleaned texts without stopwords, lemmas looked up."""
    return (f"(SELECT s.{key}, coalesce(string_agg(coalesce(lemma, form), ' ' ORDER BY pos), '') AS "
            f"clean_text FROM ({source}) s LEFT JOIN (SELECT {key}, unnest(t) AS form, "
            f"unnest(range(len(t))) AS pos FROM (SELECT {key}, list_filter(string_split("
            f"{clean(text)}, ' '), lambda x: x <> '' AND x NOT IN {in_list(DROPPED)}) AS t "
            f"FROM ({source}))) w ON s.{key} = w.{key} LEFT JOIN ({LEMMA_TABLE}) USING (form) "
            f"GROUP BY s.{key})")


LABELED_AND_SPLIT = f"SELECT *, {SORT_KEY} < '33333333' AS test FROM ({LABELED})"
PLAIN_FIT = f"(SELECT id, {clean('comment_text')} AS clean_text FROM l)"
LEMMA_FIT = with_lemmas("SELECT id, comment_text FROM l", "id", "comment_text")


# Multinomial naive Bayes in closed form: fitted on the training part, judged on the rest.
def fit_ctes(cleaned: str = PLAIN_FIT) -> str:
    every = " UNION ALL ".join(f"SELECT id, {lit(c)} AS label, {c} AS actual, test FROM l"
                               for c in tables.LABELS)
    return f"""WITH l AS ({LABELED_AND_SPLIT}),
c AS (SELECT id AS doc_id, clean_text, test FROM l JOIN {cleaned} USING (id)),
{TERM_CTES},
everything AS ({every}),
learnable AS (SELECT label FROM everything WHERE NOT test GROUP BY label
  HAVING count(DISTINCT actual) = 2),
y AS (SELECT * FROM everything WHERE label IN (SELECT label FROM learnable)),
classes AS (SELECT label, actual AS cls, count(*) AS n FROM y WHERE NOT test GROUP BY ALL),
sums AS (SELECT label, actual AS cls, term, sum(weight) AS s FROM weights JOIN y ON id = doc_id
  WHERE NOT test GROUP BY ALL),
totals AS (SELECT label, cls, sum(s) AS total FROM sums GROUP BY ALL),
theta AS (SELECT classes.label, classes.cls, vocab.term, ln(coalesce(s, 0) + 0.1)
    - ln(total + 0.1 * (SELECT count(*) FROM vocab)) AS t
  FROM classes CROSS JOIN vocab JOIN totals USING (label, cls) LEFT JOIN sums
  ON sums.label = classes.label AND sums.cls = classes.cls AND sums.term = vocab.term),
priors AS (SELECT label, cls, ln(n / sum(n) OVER (PARTITION BY label)) AS p FROM classes)"""


def naive_bayes(cleaned: str = PLAIN_FIT) -> str:
    return f"""{fit_ctes(cleaned)},
scores AS (SELECT y.id, y.label, y.actual, priors.cls, any_value(p) + coalesce(sum(weight * t), 0)
    AS score FROM y JOIN priors ON y.label = priors.label LEFT JOIN weights ON doc_id = y.id
  LEFT JOIN theta ON theta.label = y.label AND theta.cls = priors.cls AND theta.term = weights.term
  WHERE y.test GROUP BY y.id, y.label, y.actual, priors.cls),
u AS (SELECT label, actual, CAST(max(score) FILTER (cls = 1) > max(score) FILTER (cls = 0) AS INT)
  AS predicted FROM scores GROUP BY id, label, actual)
SELECT label, {', '.join(f"{metric(m)} AS {m}" for m in ('accuracy', 'precision', 'recall', 'f1'))}
FROM u GROUP BY label"""


def regression_rows(cleaned: str = PLAIN_FIT) -> str:
    return (f"{fit_ctes(cleaned)} SELECT label, count(*) AS rows, sum(actual)::BIGINT AS positives, "
            "(SELECT count(*) FROM vocab) AS vocabulary, 1 AS solved FROM y WHERE NOT test "
            "GROUP BY label")


def predict_ctes(source: str, keys: str, fitted: str = PLAIN_FIT, cleaned: str = "") -> str:
    """``wide``: the probability of every label for the texts of ``source``, exact and rounded."""
    names = [k.strip() for k in keys.split(",")]
    same = " AND ".join(f"x.{k} = tc.{k}" for k in names)
    tk = ", ".join(f"tc.{k}" for k in names)
    cleaned = cleaned or f"(SELECT {keys}, {clean('text')} AS clean_text FROM ({source}))"
    return f"""{fit_ctes(fitted)},
tc AS {cleaned},
tuni AS (SELECT {keys}, unnest(t) AS term, unnest(range(len(t))) AS position FROM (SELECT
  {keys}, list_filter(string_split(clean_text, ' '), lambda x: length(x) >= 2) AS t FROM tc)),
tterms AS (SELECT {keys}, term FROM tuni UNION ALL SELECT {keys}, term || ' ' ||
  lead(term) OVER (PARTITION BY {keys} ORDER BY position) FROM tuni),
ttf AS (SELECT {keys}, term, count(*) AS tf FROM tterms WHERE term IS NOT NULL GROUP BY ALL),
traw AS (SELECT {keys}, term, (1 + ln(ttf.tf)) * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w
  FROM ttf JOIN vocab USING (term), total),
tw AS (SELECT {keys}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {keys})) AS weight FROM traw),
by_class AS (SELECT {keys}, label, cls, sum(weight * t) AS s FROM tw JOIN theta USING (term)
  GROUP BY ALL),
class_scores AS (SELECT {tk}, priors.label, priors.cls, p + coalesce(s, 0) AS score
  FROM tc CROSS JOIN priors LEFT JOIN by_class x ON {same} AND
  x.label = priors.label AND x.cls = priors.cls),
prob AS (SELECT {keys}, label, 1 / (1 + exp(max(score) FILTER (cls = 0)
  - max(score) FILTER (cls = 1))) AS p FROM class_scores GROUP BY ALL),
exact AS (SELECT {keys}, {', '.join(f"max(p) FILTER (label = {lit(c)}) AS e_{c}"
                                    for c in tables.LABELS)} FROM prob GROUP BY ALL),
wide AS (SELECT *, {', '.join(f"{rounded(f'e_{c}', 4)} AS p_{c}" for c in tables.LABELS)} FROM exact)"""


def detected(threshold: float) -> str:
    """The labels found, in order, as a list."""
    return ("list_filter([" + ", ".join(f"CASE WHEN e_{c} >= {threshold} THEN {lit(c)} END"
                                        for c in tables.LABELS) + "], lambda x: x IS NOT NULL)")


HIGHEST = f"greatest({', '.join(f'p_{c}' for c in tables.LABELS)})"


def predictions(source: str, keys: str, fitted: str = PLAIN_FIT, cleaned: str = "") -> str:
    return (f"{predict_ctes(source, keys, fitted, cleaned)} SELECT {keys}, "
            f"CAST(len({detected(0.3)}) > 0 AS INT) AS is_toxic, {HIGHEST} AS confidence, "
            + ", ".join(f"p_{c}" for c in tables.LABELS)
            + f", array_to_string({detected(0.3)}, ' ') AS types FROM wide")


PREDICTION_TABLE = f"""{predict_ctes(DOCUMENTS, 'doc_id')}
SELECT doc_id, left(text, 44) AS "Text",
  CASE WHEN len({detected(0.3)}) > 0 THEN '🔴 YES' ELSE '🟢 NO' END AS "Toxic",
  format('{{:.0f}}%', {HIGHEST} * 100) AS "Conf",
  CASE WHEN len({detected(0.3)}) = 0 THEN '-'
    ELSE array_to_string({detected(0.3)}[1:2], ', ') END AS "Types"
FROM wide JOIN documents USING (doc_id)"""
ANALYZE_MODEL = f"""{predict_ctes(DOCUMENTS, 'doc_id')}, {score_ctes(DOCUMENTS)}
SELECT doc_id, CAST(len({detected(0.5)}) > 0 AS INT) AS is_toxic, {HIGHEST} AS confidence,
  array_to_string({detected(0.5)}, ' ') AS types, toxic_count, intensity_score
FROM wide JOIN scored USING (doc_id)"""
SAVED_MODEL = f"""{fit_ctes()} SELECT row_number() OVER (ORDER BY term) - 1 AS idx, term,
  round(ln((1 + any_value(n)) / (1 + any_value(df))::DOUBLE) + 1, 9) AS idf,
  round(max(t) FILTER (cls = 0), 6) AS clean, round(max(t) FILTER (cls = 1), 6) AS toxic
FROM vocab JOIN theta USING (term), total WHERE label = 'toxic' GROUP BY term"""

NOUN_RULES = rows(NOUN_ENDINGS)


def lemmatized(source: str, keys: str) -> str:
    return f"""WITH RECURSIVE
rules AS (SELECT *, row_number() OVER () AS k FROM {NOUN_RULES} AS r(old, new)),
docs AS (SELECT {keys}, string_split({clean('text')}, ' ') AS t FROM ({source})),
toks AS (SELECT {keys}, unnest(t) AS form, unnest(range(len(t))) AS pos FROM docs),
forms AS (SELECT DISTINCT form FROM toks WHERE form <> ''),
nouns AS (SELECT DISTINCT unnest(string_split({clean('text')}, ' ')) AS noun FROM benchmark),
cand(form, lvl, k, cand) AS (
  SELECT form, 1, k, left(form, length(form) - length(old)) || new FROM forms, rules
    WHERE ends_with(form, old)
  UNION SELECT c.form, lvl + 1, 1, left(cand, length(cand) - length(old)) || new FROM cand c, rules
    WHERE ends_with(cand, old)),
every AS (SELECT * FROM cand UNION ALL SELECT form, 1, 0, form FROM forms),
best AS (SELECT form, arg_min(cand, (lvl, length(cand), k, cand)) AS lemma
  FROM every JOIN nouns ON cand = noun WHERE noun <> '' GROUP BY form)
SELECT {keys}, string_agg(coalesce(lemma, form), ' ' ORDER BY pos) AS out
FROM toks LEFT JOIN best USING (form) GROUP BY ALL"""


LONG_WORDS = f"""(SELECT DISTINCT word AS term, left(word, length(word) - 1) AS neutral FROM
  (SELECT {sub('tok', f'[^{W}]', '')} AS word FROM (SELECT unnest(regexp_split_to_array(
    lower(coalesce(text, '')), '[{S}]+')) AS tok FROM documents)) WHERE length(word) >= 10)"""

TABLE_REPLACED = f"""WITH RECURSIVE terms AS (SELECT * FROM {LONG_WORDS}),
chains(start, term, neutral) AS (SELECT term, term, neutral FROM terms
  UNION ALL SELECT c.start, t.term, t.neutral FROM chains c JOIN terms t ON c.neutral = t.term),
ends AS (SELECT start, arg_min(neutral, length(neutral)) AS last FROM chains GROUP BY start),
parts AS (SELECT doc_id, unnest(p) AS piece, unnest(range(len(p))) AS k FROM
  (SELECT doc_id, regexp_extract_all(text, {lit(PIECES)}) AS p FROM ({REMARKS}))),
texts AS (SELECT doc_id, string_agg(coalesce(last, piece), '' ORDER BY k) AS out
  FROM parts LEFT JOIN ends ON lower(piece) = start GROUP BY doc_id),
logs AS (SELECT doc_id, string_agg(term || '=>' || neutral, '|' ORDER BY length(term) DESC, term)
    AS changes FROM (SELECT DISTINCT doc_id, term, neutral FROM parts JOIN chains
    ON lower(piece) = start) GROUP BY doc_id)
SELECT s.doc_id, coalesce(t.out, s.text) AS out, coalesce(changes, '') AS changes
FROM ({REMARKS}) s LEFT JOIN texts t USING (doc_id) LEFT JOIN logs USING (doc_id)"""


LARGE_LEXICON = f"""WITH extra AS (SELECT DISTINCT word AS term FROM
  (SELECT {sub('tok', f'[^{W}]', '')} AS word FROM (SELECT unnest(regexp_split_to_array(
    lower(coalesce(text, '')), '[{S}]+')) AS tok FROM documents)) WHERE length(word) >= 10
  UNION SELECT unnest(['a ', 'of th', 'é d'])),
lex AS (SELECT term, 'custom' AS category, 100000 AS ord FROM extra UNION ALL
  SELECT * FROM {LEXICON} AS l(term, category, ord) WHERE term NOT IN (SELECT term FROM extra)),
{token_ctes(REMARKS)},
thits AS (SELECT doc_id, word, category, 1000000 + pos AS rank, false AS is_phrase, has_intensifier,
  is_negated FROM flagged JOIN lex ON word = term WHERE NOT contains(term, ' ')),
phits AS (SELECT doc_id, term, category, ord AS rank, true, false, false
  FROM src JOIN (SELECT * FROM lex WHERE contains(term, ' ')) ON contains(lower(text), term)),
hits AS (SELECT * FROM thits UNION ALL SELECT * FROM phits),
per_text AS (SELECT doc_id, count(*) AS c, count(*) FILTER (has_intensifier) AS ni,
  count(*) FILTER (category = 'threat') AS nt, count(*) FILTER (is_negated) AS nn,
  string_agg(DISTINCT category, ' ' ORDER BY category) AS types,
  string_agg(word, ' ' ORDER BY rank, word) AS hit_words FROM hits GROUP BY doc_id),
pieces AS (SELECT doc_id, unnest(parts) AS p, unnest(range(len(parts))) AS k FROM
  (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[{S}]+|[^{S}]+') AS parts FROM src)),
marked AS (SELECT doc_id, string_agg(CASE WHEN term IS NOT NULL THEN {MARKED} ELSE {escaped('p')} END,
    '' ORDER BY k) AS highlighted_text
  FROM pieces LEFT JOIN (SELECT term FROM lex WHERE NOT contains(term, ' '))
    ON lower({core('p', 2)}) = term GROUP BY doc_id),
others AS (SELECT doc_id, string_agg(tok, ' ' ORDER BY pos) AS other_words FROM toks
  WHERE (doc_id, pos) NOT IN (SELECT doc_id, rank - 1000000 FROM thits) GROUP BY doc_id)
SELECT s.doc_id, coalesce(m.highlighted_text, '') AS highlighted_text,
  coalesce(o.other_words, '') AS other_words, CAST(coalesce(c, 0) > 0 AS INT) AS is_toxic, coalesce(types, '') AS types,
  coalesce(c, 0) AS toxic_count, coalesce(hit_words, '') AS hit_words,
  CASE WHEN c IS NULL THEN 0.0::DOUBLE ELSE {rounded('least(1.0, greatest(0.0, raw))', 3)} END
    AS intensity_score, least(1.0, 2 * CASE WHEN c IS NULL THEN 0.0::DOUBLE ELSE
    {rounded('least(1.0, greatest(0.0, raw))', 3)} END)::DOUBLE AS confidence
FROM (SELECT src.doc_id, h.*, c / len(arr)::DOUBLE + {steps(tables.INTENSIFIER_BOOST, 'ni')} +
  {steps(tables.THREAT_BOOST, 'nt')} - {steps(tables.NEGATION_DISCOUNT, 'nn')} AS raw
  FROM src JOIN arr USING (doc_id) LEFT JOIN (SELECT doc_id AS key, * EXCLUDE (doc_id) FROM per_text)
  h ON src.doc_id = h.key) s LEFT JOIN marked m USING (doc_id) LEFT JOIN others o USING (doc_id)"""
MISSING_IDS = f"(SELECT * REPLACE (CASE WHEN id::BIGINT % 3 <> 0 THEN id END AS id) FROM ({LABELED}))"


def key_without_id(columns: list[str]) -> str:
    rest = ", ".join(f"CAST({c} AS VARCHAR)" for c in sorted(columns))
    return f"md5('42:' || coalesce(id, concat_ws('|', 'missing', {rest})))"


def demo(kind: list[str]) -> str:
    def pick(words, shift=0):
        return f"list_extract([{', '.join(lit(w) for w in words)}], (i + {shift}) % {len(words)} + 1)"

    text = pick(kind)
    for slot, words, shift in (("insult1", tables.DEMO_INSULTS, 0), ("insult2", tables.DEMO_INSULTS, 1),
                               ("hate", tables.DEMO_HATE, 0), ("adj1", tables.DEMO_ADJECTIVES, 0),
                               ("adj2", tables.DEMO_ADJECTIVES, 1),
                               ("command", tables.DEMO_COMMANDS, 0)):
        text = f"replace({text}, '{{{slot}}}', {pick(words, shift)})"
    return text


def any_in(expr: str, words) -> str:
    return "CAST(" + " OR ".join(f"contains({expr}, {lit(w)})" for w in words) + " AS INT)"


def demo_corpus(n: str) -> str:
    """``demo_corpus``: half of the ``n`` comments toxic, half clean."""
    none = ", ".join(f"0 AS {c}" for c in tables.LABELS[1:])
    flags = {"severe_toxic": "CAST(i % 10 = 0 AS INT)", "obscene": "CAST(i % 3 = 0 AS INT)",
             "threat": any_in("t", tables.DEMO_THREATS), "insult": any_in("t", tables.DEMO_INSULTS),
             "identity_hate": "CAST(i % 8 = 0 AS INT)"}
    listed = ", ".join(f"{flags[c]} AS {c}" for c in tables.LABELS[1:])
    numbers = f"(SELECT unnest(range(({n}) // 2)) AS i)"
    return (f"SELECT 't' || i AS id, t AS comment_text, 1 AS toxic, {listed} FROM (SELECT i, "
            f"{demo(tables.DEMO_TOXIC)} AS t FROM {numbers}) UNION ALL SELECT 'c' || i, "
            f"{demo(tables.DEMO_CLEAN)}, 0, {none} FROM {numbers}")


def strategy_row(name: str, rules: bool) -> str:
    return (f"SELECT {lit(name)} AS strategy, count(*) AS texts, "
            "sum(length(neutral_text))::BIGINT AS chars, sum(changes)::BIGINT AS changes "
            f"FROM ({neutralized(REMARKS, rules)})")


def sql_by_query() -> dict[str, str]:
    detect = f"WITH {score_ctes(REMARKS)}"
    plain = f"WITH {score_ctes(DOCUMENTS)}"
    full = f"WITH {analyzed(DOCUMENTS)}"
    blank = f"SELECT doc_id, coalesce(text, '') AS t, text FROM ({GAPPY}) " \
            f"WHERE NOT regexp_matches(coalesce(text, ''), '[^{S}]')"
    lines = (f"SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS line_no FROM (SELECT "
             f"doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda t: "
             f"{strip('t')}), lambda t: t <> '') AS l FROM documents)")
    talk_lines = (f"SELECT conv_id, turn, unnest(l) AS text, unnest(range(len(l))) AS line_no FROM "
                  f"(SELECT conv_id, turn, list_filter(list_transform(string_split(text, chr(10)), "
                  f"lambda t: {strip('t')}), lambda t: t <> '') AS l FROM ({TALK}))")
    extended = word_steps(sorted(
        {**tables.REPLACEMENTS, "the": "a", "of and": "off"}.items(), key=lambda p: -len(p[0])))
    return {
        "scan_labeled_csv": LABELED,
        "lines_to_rows": lines,
        "demo_rows": f"SELECT doc_id AS i, {demo(tables.DEMO_TOXIC)} AS comment_text, 1 AS toxic "
                       f"FROM (SELECT *, doc_id AS i FROM documents) UNION ALL SELECT doc_id, "
                       f"{demo(tables.DEMO_CLEAN)}, 0 FROM (SELECT *, doc_id AS i FROM documents)",
        "demo_corpus": demo_corpus("SELECT 2 * count(*) FROM documents"),
        "demo_labels": f"SELECT i, 1 AS toxic, CAST(i % 10 = 0 AS INT) AS severe_toxic, "
                       f"CAST(i % 3 = 0 AS INT) AS obscene, {any_in('t', tables.DEMO_THREATS)} AS "
                       f"threat, {any_in('t', tables.DEMO_INSULTS)} AS insult, CAST(i % 8 = 0 AS INT) "
                       f"AS identity_hate FROM (SELECT i, {demo(tables.DEMO_TOXIC)} AS t FROM "
                       "(SELECT doc_id AS i FROM documents))",
        "batch_report_sink": f"WITH {analyzed(REMARKS)} {REPORT}",
        "null_to_empty": f"SELECT doc_id, coalesce(text, '') AS text FROM ({GAPPY})",
        "blank_guard": f"SELECT doc_id, t AS original_text, '' AS clean_text, t AS "
                       f"highlighted_text, t AS neutral_text, 0 AS is_toxic, 0.0::DOUBLE AS "
                       f"confidence, 0.0::DOUBLE AS intensity_score, 0 AS toxic_count, 0 AS hits, "
                       f"0 AS changes FROM ({blank})",
        "blank_guard_neutralize": f"SELECT doc_id, text AS neutral_text, 'none' AS strategy_used, "
                                  f"0.0::DOUBLE AS neutralization_score, 0 AS changes FROM ({blank})",
        "label_discovery": f"WITH l AS ({LABELED}) " + " UNION ALL ".join(
            f"SELECT {i} AS ord, {lit(c)} AS label, count(*) AS labeled_rows, "
            f"sum({c})::BIGINT AS positives FROM l"
            for i, c in enumerate(c for c in tables.LABELS if c != "obscene")),
        "filter_by_label": f"SELECT id, toxic FROM ({LABELED}) WHERE toxic = 1",
        "text_metrics": f"SELECT doc_id, length(text) AS chars, len(list_filter("
                        f"regexp_split_to_array(text, '[{S}]+'), lambda x: x <> '')) AS words "
                        "FROM documents",
        "batch_report": f"{full} {REPORT}",
        "change_log_view": f"SELECT conv_id, turn, changes, CASE WHEN strategy_used = "
                           f"'sentence_rewrite' THEN CAST(length(text) < 60 AS INT) ELSE changes - "
                           f"CAST(contains(log, {lit(tables.PHRASE_RULES[4][0] + '=>')}) AS INT) END "
                           f"AS shown FROM ({neutralized(TALK)})",
        "lowercase": "SELECT doc_id, lower(text) AS out FROM documents",
        "strip_urls": "SELECT page_id, " + sub("html", f"https?://[^{S}]+|www\\.[^{S}]+", "")
                      + " AS out FROM pages",
        "strip_html": f"SELECT page_id, {sub('html', '<.*?>', '')} AS out FROM pages",
        "keep_letters": f"SELECT doc_id, {letters('text')} AS out FROM documents",
        "strip_punct": f"SELECT doc_id, {punct_free('text')} AS out FROM documents",
        "tokenize": f"SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS position FROM "
                    f"(SELECT doc_id, list_filter(string_split(clean, ' '), lambda x: x <> '') AS t "
                    f"FROM ({SPOKEN}))",
        "drop_stopwords": f"SELECT doc_id, array_to_string(list_filter(string_split(clean, ' '), "
                          f"lambda x: x <> '' AND x NOT IN {in_list(DROPPED)}), ' ') AS out "
                          f"FROM ({SPOKEN})",
        "lemmatize": lemmatized(DOCUMENTS, "doc_id"),
        "lemmatize_talk": lemmatized(TALK, "conv_id, turn"),
        "preprocess_lemmas": f"SELECT doc_id, clean_text AS out FROM "
                             f"{with_lemmas(DOCUMENTS, 'doc_id', 'text')}",
        "preprocess_model": f"SELECT page_id, {clean('html')} AS out FROM pages",
        "preprocess_light": f"SELECT page_id, {strip(punct_free(untagged('html')))} AS out "
                            "FROM pages",
        "preprocess_batch": f"SELECT doc_id, {clean('text')} AS clean_text FROM ({GAPPY})",
        "lexicon_table": f"WITH {token_ctes(DOCUMENTS)}, d AS (SELECT word, count(DISTINCT doc_id) "
                         f"AS docs FROM toks GROUP BY word) SELECT term, category, contains(term, "
                         f"' ') AS is_phrase, ord, coalesce(docs, 0) AS docs FROM {LEXICON} AS "
                         f"l(term, category, ord) LEFT JOIN d ON word = term",
        "lexicon_extend": f"WITH {token_ctes(DOCUMENTS)}, extra AS (SELECT unnest(string_split("
                          f"lower(p_name), ' ')) AS term FROM part UNION SELECT unnest("
                          f"regexp_split_to_array(lower(text), '[{S}]+')) FROM benchmark), "
                          f"lex AS (SELECT term, 'custom' AS category FROM extra WHERE term <> '' "
                          f"UNION ALL SELECT term, category FROM {LEXICON} AS l(term, category, ord) "
                          f"WHERE term NOT IN (SELECT term FROM extra)) SELECT word, category, "
                          f"count(*) AS hits FROM toks JOIN lex ON word = term "
                          f"WHERE NOT contains(term, ' ') GROUP BY ALL",
        "lexicon_terms": f"SELECT term, count(text) AS texts FROM {LEXICON} AS l(term, category, "
                         f"ord) LEFT JOIN ({REMARKS}) ON contains(lower(text), term) GROUP BY term",
        "lexicon_summary": f"WITH {hit_ctes(REMARKS)} SELECT category, (SELECT count(*) FROM lex l "
                           f"WHERE l.category = c.category) AS terms, (SELECT count(*) FROM hits h "
                           f"WHERE h.category = c.category) AS hits FROM (SELECT DISTINCT category "
                           f"FROM lex) c",
        "phrase_hits": f"WITH {hit_ctes(REMARKS)} SELECT doc_id, word, category, position FROM phits",
        "phrase_hits_by_join": f"WITH {hit_ctes(REMARKS)} SELECT doc_id, word, category, position "
                               "FROM phits",
        "tokenize_ws": f"WITH {token_ctes(DOCUMENTS)} SELECT doc_id, pos AS position, tok AS token "
                       "FROM toks",
        "token_normalize": f"WITH {token_ctes(DOCUMENTS)} SELECT doc_id, pos AS position, word "
                           "FROM toks",
        "token_hits": f"WITH {hit_ctes(DOCUMENTS)} SELECT doc_id, position, word, category "
                      "FROM thits",
        "token_hits_by_join": f"WITH {hit_ctes(REMARKS)} SELECT * EXCLUDE (rank) FROM thits",
        "hit_intensifier": f"WITH {hit_ctes(REMARKS)} SELECT doc_id, position, word, "
                           "has_intensifier FROM thits",
        "hit_negation": f"WITH {hit_ctes(REMARKS)} SELECT doc_id, position, word, is_negated "
                        "FROM thits",
        "toxic_count": f"{detect} SELECT doc_id, toxic_count FROM scored",
        "categories_found": f"{detect} SELECT doc_id, types AS categories FROM scored",
        "non_toxic_words": f"WITH {hit_ctes(REMARKS)} SELECT doc_id, coalesce(string_agg(tok, ' ' "
                           f"ORDER BY pos) FILTER (position IS NULL), '') AS words FROM toks LEFT "
                           f"JOIN (SELECT doc_id, position FROM thits) h ON toks.doc_id = h.doc_id "
                           f"AND pos = position GROUP BY ALL".replace("SELECT doc_id, coalesce",
                                                                      "SELECT toks.doc_id, coalesce"),
        "intensity_score": f"{detect} SELECT doc_id, intensity_score FROM scored",
        "highlight": f"SELECT doc_id, {highlighted('text')} AS highlighted_text FROM ({REMARKS})",
        "detect_large_lexicon": LARGE_LEXICON,
        "detect": f"{plain} SELECT doc_id, toxic_count, types AS categories, intensity_score, "
                  "hit_words, n - nw AS other_words FROM scored",
        "sentence_rewrite": f"SELECT conv_id, turn, {SENTENCE} AS sentence FROM ({TALK})",
        "word_replacement_table": TABLE_REPLACED,
        "word_replacement": f"SELECT doc_id, cur AS out, substr(log, 2) AS changes FROM "
                            f"({chain(REMARKS, word_steps())})",
        "phrase_rules": f"SELECT doc_id, cur AS out, substr(log, 2) AS changes FROM "
                        f"({chain(REMARKS, rule_steps(), title=True)})",
        "title_case_runs": f"SELECT doc_id, {title_cased('text')} AS out FROM ({REMARKS})",
        "final_cleanup": f"SELECT doc_id, {finished('text')} AS out FROM ({REMARKS})",
        "neutralization_score": f"SELECT doc_id, neutralization_score FROM ({neutralized(REMARKS)})",
        "neutralize": f"SELECT doc_id, neutral_text, strategy_used, log AS changes FROM "
                      f"({neutralized(REMARKS)})",
        "strategy_switch": " UNION ALL ".join([
            strategy_row("combined", True), strategy_row("rule_based", True),
            strategy_row("word_replacement", False), strategy_row("transformer", False)]),
        "batch_neutralize": f"SELECT conv_id, turn, neutral_text, strategy_used, "
                            f"neutralization_score FROM ({neutralized(TALK)})",
        "neutralize_text": f"SELECT neutral_text FROM ({neutralized(DOCUMENTS)})",
        "replacement_extend": f"SELECT doc_id, cur AS out FROM ({chain(REMARKS, extended)})",
        "replacement_order": "WITH w AS (SELECT term, count(*) AS uses FROM (SELECT lower(p_type) AS "
                             "term FROM part UNION ALL SELECT lower(c_mktsegment) FROM customer) "
                             "GROUP BY term) SELECT term, row_number() OVER (ORDER BY length(term) "
                             "DESC, uses DESC, term) AS step FROM w",
        "analyze_lexicon": f"{detect} SELECT doc_id, {VERDICT} FROM scored",
        "conditional_neutralize": f"{full} SELECT doc_id, CAST(toxic_count > 0 AS INT) AS is_toxic, "
                                  "neutral_text, changes FROM analysis",
        "analyze": f"{full} SELECT doc_id, text AS original_text, {clean('text')} AS clean_text, "
                   f"{VERDICT}, hit_words, {highlighted('text')} AS highlighted_text, neutral_text, "
                   "log AS changes FROM analysis",
        "batch_analyze": f"WITH {score_ctes(talk_lines, 'conv_id, turn, line_no')} SELECT conv_id, "
                         f"turn, line_no, text AS line, {VERDICT} FROM scored",
        "batch_summary": f"{plain} SELECT count(*) AS total, count(*) FILTER (toxic_count > 0) AS "
                         f"toxic, count(*) FILTER (toxic_count = 0) AS clean, "
                         f"{rounded('count(*) FILTER (toxic_count > 0) / count(*)::DOUBLE * 100', 1)} "
                         "AS toxic_rate FROM scored",
        "residual_toxicity": f"{full}, again AS (WITH "
                             f"{hit_ctes('SELECT doc_id, neutral_text AS text FROM analysis')} "
                             f"SELECT doc_id, count(*) AS c FROM hits GROUP BY doc_id) SELECT doc_id, "
                             f"toxic_count, coalesce(c, 0) AS residual_count FROM analysis LEFT JOIN "
                             f"again USING (doc_id)",
        "corpus_stats": "SELECT count(*) AS comments, avg(length(text)) AS avg_length FROM documents",
        "label_distribution": f"WITH l AS ({LABELED}) " + " UNION ALL ".join(
            f"SELECT {lit(c)} AS label, sum({c})::BIGINT AS positives, "
            f"sum({c}) / count(*)::DOUBLE * 100 AS percent FROM l" for c in tables.LABELS),
        "label_count": f"SELECT id, {ALL_LABELS} AS label_count FROM ({LABELED})",
        "multilabel_stats": f"SELECT count(*) FILTER ({ALL_LABELS} > 1) AS multi_label, "
                            f"max({ALL_LABELS}) AS max_labels FROM ({LABELED})",
        "clean_toxic_split": f"SELECT clean, clean / n::DOUBLE * 100 AS clean_percent, n - clean AS "
                             f"toxic, (n - clean) / n::DOUBLE * 100 AS toxic_percent FROM (SELECT "
                             f"count(*) AS n, count(*) FILTER ({ALL_LABELS} = 0) AS clean FROM "
                             f"({LABELED}))",
        "binary_metrics": f"{METRICS} SELECT * FROM m",
        "macro_average": f"{METRICS} SELECT avg(accuracy) AS accuracy, avg(precision) AS precision, "
                         "avg(recall) AS recall, avg(f1) AS f1 FROM m",
        "evaluation_report": f"{METRICS}, a AS (SELECT * FROM m UNION ALL SELECT 'AVERAGE', "
                             "avg(accuracy), avg(precision), avg(recall), avg(f1) FROM m) SELECT "
                             "label, round(accuracy, 3) AS accuracy, round(precision, 3) AS "
                             "precision, round(recall, 3) AS recall, round(f1, 3) AS f1 FROM a",
        "balanced_sample": f"WITH l AS (SELECT id, toxic, row_number() OVER (PARTITION BY toxic ORDER "
                           f"BY {key_without_id(['toxic'])}, id) AS k FROM {MISSING_IDS}), q AS (SELECT count(*) // 2 AS "
                           "size, least(count(*) // 2 // 4, sum(toxic)) AS t FROM l) SELECT id, toxic "
                           "FROM l, q WHERE k <= CASE toxic WHEN 1 THEN t ELSE size - t END",
        "concat_rows": f"WITH l AS ({LABELED}) SELECT id, toxic, insult FROM l WHERE toxic = 1 UNION "
                       "ALL SELECT id, toxic, insult FROM l WHERE insult = 0",
        "shuffle_rows": f"SELECT id, {SORT_KEY} AS sort_key FROM ({LABELED})",
        "train_test_split": "SELECT id, CASE WHEN "
                            + key_without_id(["comment_text", *tables.LABELS])
                            + f" < '33333333' THEN 'test' ELSE 'train' END AS part FROM {MISSING_IDS}",
        "term_tokens": f"WITH {TERMS} SELECT c.doc_id, coalesce(string_agg(term, ' ' ORDER BY "
                       "position), '') AS tokens FROM c LEFT JOIN uni USING (doc_id) GROUP BY ALL",
        "strip_accents": "SELECT doc_id, strip_accents(text) AS out FROM documents",
        "ngrams_1_2": f"WITH {TERMS} SELECT doc_id, term, position FROM terms",
        "df_pruning": f"WITH {TERMS} SELECT * FROM pruned",
        "vocab_top_k": f"WITH {TERMS} SELECT * FROM pruned ORDER BY tf DESC, term LIMIT 50000",
        "tfidf": f"WITH {TERMS} SELECT doc_id, term, round(weight, 6) AS weight FROM weights",
        "train_lr_minimum": regression_rows(),
        "train_minimum": regression_rows(LEMMA_FIT),
        "train_nb": naive_bayes(),
        "train_nb_lemmas": naive_bayes(LEMMA_FIT),
        "predict": predictions(DOCUMENTS, "doc_id"),
        "predict_lemmas": predictions(DOCUMENTS, "doc_id", LEMMA_FIT,
                                      with_lemmas(DOCUMENTS, "doc_id", "text")),
        "predict_batch": predictions(TALK, "conv_id, turn"),
        "prediction_table": PREDICTION_TABLE,
        "analyze_model": ANALYZE_MODEL,
        "model_save": SAVED_MODEL,
        "model_load": "SELECT model, count(*) AS texts, count(*) AS equal FROM documents, "
                      f"{rows([[k] for k in MODEL_TYPES])} AS kinds(model) GROUP BY model",
        "doc_vectors": f"WITH {TERMS} SELECT c.doc_id, count(term) AS entries, "
                       "round(coalesce(sum(weight * weight), 0), 6) AS squared_length FROM c LEFT "
                       "JOIN weights USING (doc_id) GROUP BY c.doc_id",
    }

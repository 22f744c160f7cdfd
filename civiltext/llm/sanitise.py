"""Personal data, and terms that give away whom a text is about, with DataFrame functions only.

Known forms (e-mail and IP addresses, payment cards, phone numbers) are found by pattern,
leftmost and not overlapping per kind. They are the protected entities. Information-theoretic
sanitisation then finds terms that reveal them: from co-occurrence over the whole corpus, a term
``t`` gives ``log2(P(e|t) / P(e))`` of the ``-log2 P(e)`` bits that identify entity ``e``. Terms
that give ``disclosure`` or more of these bits, and stand in at least ``support`` texts with the
entity, become spans of kind ``term`` wherever they stand in a text with that entity, however far
from it. Sanitising replaces known forms by their kind and removes such terms.

All counts are of different texts (by a hash of the text), so copies of a text count once: ``P(e)``
is the share of texts with ``e``, ``P(e|t)`` that of the texts with ``t`` that have ``e``. Terms are
lower-cased runs of three letters or more; a mention inside a known form is no span of its own.

A missing text is empty. Rows equal in id and text get equal results. Offsets are code points,
ends are exclusive. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from civiltext.functions.barrier import computed_once
from civiltext.sources.shared import cut_lineage

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
SUPPORT = 2
DISCLOSURE = 0.9

# Look-behinds keep long runs of a class from being tried from each of their characters: a run
# that fails from its start fails from everywhere. \G allows one right after the last match.
_EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@"
          r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[ -]?[0-9])++"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_WORD = r"\p{L}{3,}"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_card(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)


#: Kind, pattern, character every match has, further condition.
_FORMS = (
    ("email", _EMAIL, "@", lambda v: F.lit(True)),
    ("ip", _IP, ".", lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
    ("card", _CARD, None, _is_card),
    ("phone", _PHONE, "+", lambda v: F.length(_digits(v)).between(10, 15)),
)


def _matches(text: Column, pattern: str, name: str, number: int, valid) -> Column:
    """Matches of ``pattern`` with their places, as structs; those not ``valid`` are left out.

    The text between matches tells where each one starts.
    """
    zipped = F.arrays_zip(F.split(text, pattern, -1),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    kind = "array<struct<start:int,number:int,end_:int,kind:string,value:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))

    def step(state: Column, part: Column) -> Column:
        value = part["1"]
        begin = state["at"] + F.length(part["0"])
        end = begin + F.length(value)
        span = F.struct(begin.alias("start"), F.lit(number).alias("number"), end.alias("end_"),
                        F.lit(name).alias("kind"), value.alias("value"))
        found = F.when(value.isNotNull() & valid(value), F.concat(state["found"], F.array(span))) \
                 .otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    return F.aggregate(zipped, start, step, lambda state: state["found"])


def known_forms(text: Column) -> Column:
    """All spans of known forms in ``text``, by start and kind."""
    every = []
    for number, (name, pattern, sign, valid) in enumerate(_FORMS):
        found = _matches(text, pattern, name, number, valid)
        if sign:
            found = F.when(F.contains(text, F.lit(sign)), found)
        every.append(F.coalesce(found, F.array().cast(
            "array<struct<start:int,number:int,end_:int,kind:string,value:string>>")))
    return F.array_sort(F.concat(*every))


def _entity(span: Column) -> Column:
    value = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])) \
             .otherwise(F.lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), value)


def _distinct_words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0)))


def _mentions(text: Column, terms: Column, forms: Column) -> Column:
    """Spans of the words in ``terms`` outside the known forms."""
    found = _matches(text, _WORD, TERM, len(KINDS), lambda v: F.array_contains(terms, F.lower(v)))
    return F.filter(found, lambda s: ~F.exists(forms, lambda f: (f["start"] < s["end_"])
                                               & (s["start"] < f["end_"])))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """``id, key, spans``, one row per row of ``docs``.

    ``spans`` has ``start, number, end_, kind``, ordered by start and kind; ``key`` is a hash of
    the text, which with the id tells rows apart.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")) \
               .withColumn("key", F.xxhash64("text"))
    around = computed_once(docs, {"forms": known_forms(F.col("text"))})
    # Texts without entities are not needed again.
    around = cut_lineage(around.select(
        "id", "key", F.when(F.size("forms") > 0, F.col("text")).alias("text"),
        F.transform("forms", lambda s: F.struct(
            s["start"], s["number"], s["end_"], s["kind"], _entity(s).alias("entity")))
        .alias("forms")))
    entities = F.array_distinct(F.transform("forms", lambda s: s["entity"]))
    own = around.filter("text IS NOT NULL").select("id", "key", "text", entities.alias("entities"))
    once = own.dropDuplicates(["key"])
    # An entity of fewer texts than ``support`` has no term in that many.
    named = (once.select(F.explode("entities").alias("entity")).groupBy("entity")
             .agg(F.count("*").alias("with_entity")).filter(F.col("with_entity") >= support))
    together = (once.select(F.explode("entities").alias("entity"), "text")
                .join(named.select("entity"), "entity")
                .select("entity", F.explode(_distinct_words(F.col("text"))).alias("term"))
                .groupBy("entity", "term").agg(F.count("*").alias("both"))
                .filter(F.col("both") >= support))
    known = (docs.select("key", "text").dropDuplicates(["key"])
             .select(F.explode(_distinct_words(F.col("text"))).alias("term"))
             .groupBy("term").agg(F.count("*").alias("with_term")))
    total = around.agg(F.count_distinct("key")).first()[0]
    share = F.col("with_entity") / total
    revealed = F.log2(F.col("both") / F.col("with_term") / share) / -F.log2(share)
    reveals = (together.join(named, "entity").join(known, "term")
               .filter((share < 1) & (revealed >= disclosure)).select("entity", "term"))
    added = (own.select("id", "key", F.explode("entities").alias("entity"))
             .join(reveals, "entity").groupBy("id", "key")
             .agg(F.collect_set("term").alias("terms"))
             .select(F.col("id").alias("added_id"), F.col("key").alias("added_key"), "terms"))
    base = F.transform("forms", lambda s: F.struct(s["start"], s["number"], s["end_"], s["kind"]))
    more = F.transform(_mentions(F.col("text"), F.col("terms"), F.col("forms")), lambda s:
                       F.struct(s["start"], s["number"], s["end_"], s["kind"]))
    kind = "array<struct<start:int,number:int,end_:int,kind:string>>"
    return around.join(added, (F.col("key") == F.col("added_key"))
                       & F.col("id").eqNullSafe(F.col("added_id")), "left").select(
        "id", "key", F.when(F.col("terms").isNull(), base.cast(kind)).otherwise(
            F.array_sort(F.concat(base.cast(kind), more.cast(kind)))).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with known forms replaced by their kind in brackets and terms removed.

    Of overlapping spans the first is replaced and the rest of the others removed.
    """
    def step(state: Column, span: Column) -> Column:
        put = F.when(span["kind"] == TERM, "").otherwise(
            F.concat(F.lit("["), span["kind"], F.lit("]")))
        free = span["start"] >= state["at"]
        out = F.when(free, F.concat(state["out"], F.substring(
            text, state["at"] + 1, span["start"] - state["at"]), put)).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end_"]).alias("at"), out.alias("out"))

    rest = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, rest, step, lambda state: F.concat(
        state["out"], F.substring(text, state["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             **options) -> DataFrame:
    """``id, text`` with sanitised texts, one row per distinct row of id and text."""
    found = find_personal_data(docs, id_col, text_col, **options).dropDuplicates(["id", "key"])
    texts = docs.select(F.col(id_col).alias("text_id"),
                        F.coalesce(text_col, F.lit("")).alias("text")).distinct()
    return found.join(texts, F.col("id").eqNullSafe(F.col("text_id"))
                      & (F.col("key") == F.xxhash64("text"))).select(
        "id", sanitised(F.col("text"), F.col("spans")).alias("text"))


def span_text(spans: Column) -> Column:
    """Spans joined as ``kind:start:end``."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"], s["end_"])), ",")

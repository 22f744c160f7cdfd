"""Text-cleaning column functions.

Every function takes and returns a string column and is built from native expressions, so
cleaning runs in the scan stage without a shuffle. Those that work on arrays of tokens are
interpreted per row; the others take part in whole-stage code generation.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, functions as F

from civiltext import tables
from civiltext.functions import sqltext
from civiltext.functions.patterns import SPACE, SPACES, WORD

_SPLIT_WORDS = "\\b(" + "|".join(f"{a}(?={b}\\b)" for a, b in tables.CONTRACTIONS) + ")"


def null_to_empty(text: Column) -> Column:
    """Missing text becomes the empty text."""
    return F.coalesce(text, F.lit(""))


def is_blank(text: Column) -> Column:
    """True for missing, empty and all-whitespace text."""
    return ~F.coalesce(text.rlike(f"[^{SPACE}]"), F.lit(False))


def collapse_space(text: Column) -> Column:
    """Every whitespace run becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def strip_space(text: Column) -> Column:
    """Remove whitespace at both ends only."""
    # Not a pattern: one tries every character of a run inside the text anew.
    return F.btrim(text, F.lit(SPACES))


def lowercase(text: Column) -> Column:
    return F.lower(text)


def strip_urls(text: Column) -> Column:
    """Delete web addresses; nothing is put in their place."""
    return F.regexp_replace(text, f"https?://[^{SPACE}]+|www\\.[^{SPACE}]+", "")


def strip_html(text: Column) -> Column:
    """Delete tags that open and close on one line."""
    return F.regexp_replace(text, "<[^\\n>]*>", "")


def keep_letters(text: Column) -> Column:
    """Keep ASCII letters; everything else collapses to single spaces."""
    return F.trim(F.regexp_replace(text, "[^a-zA-Z]+", " "))


def strip_punct(text: Column) -> Column:
    """Delete the 32 ASCII punctuation characters."""
    return F.translate(text, tables.PUNCTUATION, "")


def split_contractions(cleaned: Column) -> Column:
    """``cannot`` -> ``can not``, ``gonna`` -> ``gon na`` and the like, on cleaned text."""
    return F.regexp_replace(cleaned, _SPLIT_WORDS, "$1 ")


def tokenize(cleaned: Column) -> Column:
    """Word tokens of text that went through ``keep_letters``."""
    words = F.split(split_contractions(cleaned), " ")
    return F.filter(words, lambda w: w != "")


def drop_stopwords(tokens: Column, stopwords: list[str] | None = None) -> Column:
    """Remove English stopwords, except those that carry meaning here."""
    drop = [w for w in (tables.STOPWORDS if stopwords is None else stopwords)
            if w not in tables.KEPT_STOPWORDS]
    return F.filter(tokens, lambda w: ~w.isin(drop)) if drop else tokens


def preprocess(text: Column, for_model: bool = True, remove_stops: bool = False) -> Column:
    """The whole cleaning chain: lower case, no addresses, no tags, letters only.

    ``for_model=False`` is the light form that only deletes punctuation. Addresses go
    before tags, so an address inside a tag takes the rest of the tag with it.
    Lemmas are a table lookup, see ``operators.lemmas.Cleaning``, which adds them.
    """
    plain = strip_html(strip_urls(lowercase(null_to_empty(text))))
    if not for_model:
        return strip_space(strip_punct(plain))
    cleaned = keep_letters(plain)
    if remove_stops:
        return F.array_join(drop_stopwords(tokenize(cleaned)), " ")
    return split_contractions(cleaned)


def preprocess_table(df: DataFrame, text_col: str = "comment_text",
                     out: str = "clean_text", **options) -> DataFrame:
    """``preprocess`` for a whole table."""
    return df.withColumn(out, preprocess(F.col(text_col), **options))


def words_lower(text: Column) -> Column:
    """Lower-cased whitespace-separated tokens, punctuation included."""
    flat = collapse_space(F.lower(text))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def normalize_token(token: Column) -> Column:
    """Remove everything but word characters from a token."""
    return F.regexp_replace(token, f"[^{WORD}]+", "")


def char_count(text: Column) -> Column:
    return F.length(text)


def word_count(text: Column) -> Column:
    """Number of whitespace-separated tokens."""
    return F.regexp_count(text, F.lit(f"[^{SPACE}]+"))


def strip_accents(text: Column) -> Column:
    """Fold accented and composed characters to their base letters.

    Covers every character that decomposes into base letters plus accents, ligatures and Hangul
    syllables among them, and loose combining accents. Text of ASCII alone, such as went through
    ``keep_letters``, is passed on as it is.
    """
    accented, plain, marks, several = _accent_table()
    table = F.expr(sqltext.map_of(several))

    def fold(runs: Column) -> Column:
        folded = F.translate(runs, accented + marks, plain)
        spelled = F.array_join(F.transform(F.split(folded, ""), lambda c: F.coalesce(
            F.element_at(table, c), F.when(c.between(*_HANGUL), _jamo(c)), c)), "")
        # Found by deleting them: a class costs a test per member and character.
        rare = (F.translate(runs, "".join(several), "") != runs) | runs.rlike(f"[{'-'.join(_HANGUL)}]")
        return F.when(rare, spelled).otherwise(folded)

    # Runs of other characters are taken out, a line each, folded and put back.
    other = "[^\\x00-\\x7f]+"
    runs = F.array_join(F.regexp_extract_all(text, F.lit(other), F.lit(0)), "\n")
    folded = F.split(F.get(F.transform(F.array(runs), fold), F.lit(0)), "\n")
    whole = F.array_join(F.zip_with(F.split(text, other), folded,
                                    lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(text.rlike(other), whole).otherwise(text)


_HANGUL = ("\uac00", "\ud7a3")


def _jamo(syllable: Column) -> Column:
    """The two or three letters of a Hangul syllable, by its place among the syllables: 19 initial
    consonants by 21 vowels by 28 finals, of which the first is none."""
    at = F.ascii(syllable) - ord(_HANGUL[0])

    def letter(first: int, count: int, place: Column) -> Column:
        letters = ", ".join(sqltext.quote(chr(first + i)) for i in range(count))
        return F.get(F.expr(f"array({letters})"), F.floor(place).cast("int"))

    final = at % 28
    return F.concat(letter(0x1100, 19, at / 588), letter(0x1161, 21, at % 588 / 28),
                    F.when(final == 0, "").otherwise(letter(0x11A8, 27, final - 1)))


@functools.cache
def _accent_table() -> tuple[str, str, str, dict[str, str]]:
    """The accent fold, derived from the Unicode character database."""
    import sys
    import unicodedata as u
    accented, plain, marks, several = [], [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        base = [c for c in u.normalize("NFKD", ch) if not u.combining(c)]
        if not base:
            marks.append(ch)
        elif len(base) == 1 and base[0] != ch:
            accented.append(ch)
            plain.append(base[0])
        elif len(base) > 1:
            several[ch] = "".join(base)
    return "".join(accented), "".join(plain), "".join(marks), several


def squeeze(text: Column) -> Column:
    """Delete everything but word characters and whitespace from lower-cased text, in one
    pass. The look-ahead waves most characters through before the full class is tried."""
    return F.regexp_replace(text, f"(?=[^a-z ])[^{WORD}{SPACE}]+", "")


def has_whole_token(squeezed: str, terms: list[str]) -> Column:
    """True if one of ``terms`` is a whitespace-separated token of column ``squeezed``."""
    if not terms:
        return F.lit(False)
    listed = F.expr(f"array({', '.join(sqltext.quote(t) for t in terms)})")
    return F.arrays_overlap(F.split(squeezed, f"[{SPACE}]"), listed)


def contains_one_of(text: Column, needles: list[str]) -> Column:
    """True if one of a few ``needles`` occurs anywhere in ``text``."""
    return functools.reduce(operator.or_, (F.contains(text, F.lit(n)) for n in needles))

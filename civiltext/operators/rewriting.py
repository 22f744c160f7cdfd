"""Rewriting toxic texts into neutral wording, with a log of every change.

A text that a sentence rewrite applies to is replaced as a whole. Any other text goes
through word replacements and then phrase rules, each step working on the outcome of the
one before. Steps are separate columns that are null for rows not to be rewritten, so
regular expressions only run on rows that need them and nothing is computed twice.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

from civiltext import tables
from civiltext.functions import numbers, patterns, sqltext as sql, text as txt
from civiltext.functions.barrier import computed_once
from civiltext.operators.replacing import with_replacements
from civiltext.operators.rewriter import Rewriter

CHANGES = "array<struct<old:string,new:string>>"
REST = 1 << 30  # "up to the end" for substring
STRATEGIES = ["combined", "rule_based", "word_replacement", "transformer"]


@dataclass(frozen=True)
class Wording:
    """The tables a rewrite works with. Extending one makes a new object."""

    replacements: dict[str, str] = field(default_factory=lambda: dict(tables.REPLACEMENTS))
    rules: list[tuple[str, str]] = field(default_factory=lambda: list(tables.PHRASE_RULES))
    sentences: dict[str, str] = field(default_factory=lambda: dict(tables.SENTENCE_REWRITES))
    shout_only: bool = False
    #: Replacements as a table (``term, neutral, ord``) of any size, in place of ``replacements``.
    table: DataFrame | None = None

    def add_replacement(self, toxic: str, neutral: str) -> "Wording":
        if self.table is not None:
            raise ValueError("add rows to the table of replacements instead")
        return replace(self, replacements={**self.replacements, toxic.lower(): neutral.lower()})

    def application_order(self) -> list[tuple[str, str]]:
        """Longest term first; equally long terms in listing order."""
        return sorted(self.replacements.items(), key=lambda pair: -len(pair[0]))


def _log(*pairs: tuple[str, str]) -> Column:
    return F.expr(sql.changes_of(pairs))


def sentence_rewrite(text: str, wording: Wording | None = None) -> Column:
    """The fixed sentence for the first pattern column ``text`` contains; null if none."""
    cases = " ".join(f"WHEN contains(lower({text}), {sql.quote(pattern)}) THEN {sql.quote(sentence)}"
                     for pattern, sentence in (wording or Wording()).sentences.items())
    return F.expr(f"CASE {cases} END" if cases else "cast(NULL AS string)")


def independent_groups(ordered: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """Cut the replacement sequence into runs that can be applied in one pass.

    Inside a run no term shares a word with another term or with the wording of a
    replacement made earlier in the run, so applying them together or one after the other
    gives the same text. Terms that do not start and end with a word character stand alone.
    """
    groups: list[list[tuple[str, str]]] = []
    used: set[str] = set()
    alone = True
    for term, neutral in ordered:
        if not term.strip():
            continue
        term_words = set(re.findall(r"\w+", term.lower()))
        # Letters outside ASCII may match in ways the piece lookup does not reproduce.
        odd = not (term.isascii() and re.fullmatch(r"\w(.*\w)?", term, re.S))
        if alone or odd or term_words & used:
            groups.append([])
            used = set()
        groups[-1].append((term, neutral))
        used |= term_words | set(re.findall(r"\w+", neutral.lower()))
        alone = odd
    return groups


def _plain_case(piece: Column) -> Column:
    return F.lower(F.translate(piece, patterns.CASE_ODD, patterns.CASE_PLAIN))


# Put around a found term and cut at: a pair of noncharacters. The first one in a text is put
# beside another noncharacter before, so that no text holds the pair, and is restored after.
_MARK = "\ufdd2\ufdd3"
_OWN, _APART = "\ufdd2", "\ufdd2\ufdd4"


def _cut_at_terms(text: Column, terms: list[str]) -> Column:
    """``text`` cut into whole-word terms and the stretches between them."""
    term = f"(?iu){patterns.NOT_AFTER_WORD}{patterns.any_of(terms)}{patterns.NOT_BEFORE_WORD}"
    kept = F.replace(text, F.lit(_OWN), F.lit(_APART))
    pieces = F.split(F.regexp_replace(kept, term, f"{_MARK}$0{_MARK}"), _MARK)
    return F.transform(pieces, lambda p: F.replace(p, F.lit(_APART), F.lit(_OWN)))


def _neutral_of(piece: Column, group: list[tuple[str, str]]) -> Column:
    """The replacement if ``piece`` is a term, else null."""
    # The length test spares the stretches between terms the lower-casing.
    return F.when(F.octet_length(piece) <= 3 * max(len(t) for t, _ in group),
                  F.element_at(F.expr(sql.map_of(dict(group))), _plain_case(piece)))


def _join_replaced(pieces: Column, group: list[tuple[str, str]]) -> Column:
    return F.array_join(F.transform(
        pieces, lambda p: F.coalesce(_neutral_of(p, group), p)), "")


def _log_replaced(pieces: Column, group: list[tuple[str, str]]) -> Column:
    changed = F.transform(F.filter(pieces, lambda p: _neutral_of(p, group) != p), _plain_case)
    return F.filter(_log(*group), lambda c: F.array_contains(changed, c.old))


@dataclass
class Stages:
    """A chain of steps over one column: the table with a column per step, and their logs."""

    df: DataFrame
    source: str
    first: str
    columns: list[str] = field(default_factory=list)
    logs: list[Column] = field(default_factory=list)

    def step(self, name: str, text: Column, *log: tuple[str, str]) -> None:
        self.df = self.df.withColumn(name, text)
        self.columns.append(name)
        if log:
            self.logs.append(F.when(F.col(name) != F.col(self.source), _log(*log))
                             .otherwise(_log()))
        self.source = name

    def log(self) -> Column:
        """All changes in order; null where the text is null."""
        return F.when(F.col(self.first).isNotNull(),
                      F.concat(*self.logs) if self.logs else _log())

    def finish(self, out: str, log: str) -> DataFrame:
        done = computed_once(self.df, {c: F.col(c) for c in self.columns}) \
            if self.columns else self.df
        return (done.withColumn(log, self.log()).withColumn(out, F.col(self.source))
                .drop(*self.columns))


def _word_stages(stages: Stages, wording: Wording) -> None:
    if wording.table is not None:
        name = f"{stages.first}_table"
        stages.df = with_replacements(stages.df, stages.source, wording.table, name)
        stages.columns.append(name)
        stages.step(f"{name}_text", F.col(name)["text"])
        stages.logs.append(F.col(name)["log"])
        return
    for n, group in enumerate(independent_groups(wording.application_order())):
        name = f"{stages.first}_w{n}"
        if len(group) == 1:
            term, neutral = group[0]
            stages.step(name, F.regexp_replace(stages.source, patterns.whole_word(term),
                                               patterns.escape_replacement(neutral)), group[0])
            continue
        pieces = F.col(f"{name}_pieces")
        stages.df = stages.df.withColumn(
            f"{name}_pieces", _cut_at_terms(F.col(stages.source), [t for t, _ in group]))
        stages.columns.append(f"{name}_pieces")
        stages.step(name, _join_replaced(pieces, group))
        stages.logs.append(_log_replaced(pieces, group))


def _rule_stages(stages: Stages, wording: Wording) -> None:
    for n, (pattern, replacement) in enumerate(wording.rules):
        stages.step(f"{stages.first}_r{n}",
                    apply_rule(F.col(stages.source), pattern, replacement, wording.shout_only),
                    (pattern, replacement))


def replace_words(df: DataFrame, col: str, out: str, log: str,
                  wording: Wording | None = None) -> DataFrame:
    """Apply all word replacements to ``col``; whole words, any letter case.

    Appends the new text and the log of terms that changed something. Null stays null. A wording
    with a ``table`` takes replacements of any number.
    """
    stages = Stages(df, col, col)
    _word_stages(stages, wording or Wording())
    return stages.finish(out, log)


def phrase_rules(df: DataFrame, col: str, out: str, log: str,
                 wording: Wording | None = None) -> DataFrame:
    """Apply the phrase rules to ``col`` in order; appends the new text and the log."""
    stages = Stages(df, col, col)
    _rule_stages(stages, wording or Wording())
    return stages.finish(out, log)


def title_case_runs(text: Column, shout_only: bool = False) -> Column:
    """Capitalise every whole word of two or more ASCII letters.

    ``shout_only`` restricts it to words written all in capitals.
    """
    letters = "A-Z" if shout_only else "A-Za-z" + patterns.CASE_ODD
    pieces = F.regexp_extract_all(text, F.lit(f"[{patterns.WORD}]+|[^{patterns.WORD}]+"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.when(
        p.rlike(f"^[{letters}]{{2,}}\\z"),
        F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, REST))))
        .otherwise(p)), "")


def apply_rule(text: Column, pattern: str, replacement: str, shout_only: bool = False) -> Column:
    """One phrase rule, in any letter case."""
    if replacement == tables.CAPITALIZE:
        return title_case_runs(text, shout_only)
    return F.regexp_replace(text, "(?iu)" + patterns.to_java(pattern),
                            patterns.to_java_replacement(replacement))


def final_cleanup(df: DataFrame, col: str, out: str) -> DataFrame:
    """Collapse whitespace, start with a capital, end with punctuation, write ``i`` as ``I``."""
    flat, first = f"{out}_flat", f"{out}_first"
    standalone_i = f"{patterns.NOT_AFTER_WORD}i{patterns.NOT_BEFORE_WORD}"
    return (df.withColumn(flat, txt.collapse_space(F.col(col)))
            .withColumn(first, F.concat(F.upper(F.substring(flat, 1, 1)),
                                        F.substring(flat, 2, REST)))
            .withColumn(out, F.regexp_replace(
                F.when((F.col(first) == "") | F.right(first, F.lit(1)).isin(".", "!", "?"),
                       F.col(first)).otherwise(F.concat(first, F.lit("."))),
                standalone_i, "I"))
            .drop(flat, first))


def changed_chars(changes: Column) -> Column:
    """Total length of what was replaced, as the log shows it."""
    return F.aggregate(changes, F.lit(0), lambda n, c: n + F.length(c.old))


def neutralization_score(df: DataFrame, changes: str, text_col: str, out: str) -> DataFrame:
    """Share of the text that was changed, at most 1; 0 without changes."""
    share = f"{out}_share"
    return (df.withColumn(share, F.least(F.lit(1.0), F.coalesce(
                F.try_divide(changed_chars(F.col(changes)), F.length(text_col)), F.lit(0.0))))
            .withColumn(out, F.when(F.size(changes) > 0, numbers.round_exact(F.col(share), 3))
                        .otherwise(F.lit(0.0)))
            .drop(share))


def neutralize(df: DataFrame, text_col: str = "text", strategy: str = "combined",
               wording: Wording | None = None, only_when: Column | None = None) -> DataFrame:
    """Append ``neutral_text``, ``strategy_used``, ``changes_made``, ``neutralization_score``.

    ``combined`` and ``rule_based`` replace words and apply the phrase rules; every other
    strategy name replaces words only. Rows where ``only_when`` does not hold keep their
    text. Missing text stays missing.
    """
    wording = wording or Wording()
    gate = ~txt.is_blank(F.col(text_col))
    if only_when is not None:
        gate = gate & F.coalesce(only_when, F.lit(False))
    df = (df.withColumn("_todo", F.when(gate, F.col(text_col)))
          .withColumn("_sentence", sentence_rewrite("_todo", wording))
          .withColumn("_in", F.when(F.col("_sentence").isNull(), F.col("_todo"))))
    with_rules = strategy in ("combined", "rule_based")
    if wording.table is None:
        # All steps at once, in a worker: a column for each costs several times as much.
        rewriter = Rewriter(wording.application_order(), wording.rules if with_rules else [],
                            wording.shout_only, clean=True)
        own = ["_sentence", "_in", "_new"]
        df = computed_once(df.withColumn("_new", rewriter.column(F.col("_in"))),
                           {c: F.col(c) for c in own}, "_todo")
        clean, log = F.col("_new.text"), F.col("_new.log")
    else:
        stages = Stages(df, "_in", "_in")
        _word_stages(stages, wording)
        if with_rules:
            _rule_stages(stages, wording)
        own = ["_sentence", "_in", "_clean", *stages.columns]
        df = computed_once(final_cleanup(stages.df, stages.source, "_clean"),
                           {c: F.col(c) for c in own}, "_todo")
        clean, log = F.col("_clean"), stages.log()
    whole = F.array(F.struct(F.col(text_col).alias("old"), F.col("_sentence").alias("new")))
    df = df.withColumn("changes_made", F.when(F.col("_sentence").isNotNull(), whole.cast(CHANGES))
                       .otherwise(F.coalesce(log, _log())))
    df = neutralization_score(df, "changes_made", text_col, "neutralization_score")
    return df.withColumns({
        "neutral_text": F.coalesce(F.col("_sentence"), clean, F.col(text_col)),
        "strategy_used": F.when(F.col("_sentence").isNotNull(), F.lit("sentence_rewrite"))
                          .when(F.size("changes_made") > 0, F.lit("combined"))
                          .otherwise(F.lit("none")),
    }).drop(*own)


def neutralize_text(text_col: str, df: DataFrame) -> DataFrame:
    """Only the neutral text, by the default strategy."""
    return neutralize(df, text_col).select("neutral_text")


def short_changes(changes: Column, below: int = 60) -> Column:
    """The changes worth showing: those whose old text is shorter than ``below``."""
    return F.filter(changes, lambda c: F.length(c.old) < below)

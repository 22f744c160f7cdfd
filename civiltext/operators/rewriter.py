"""Rewriting texts in the memory of a worker, one after the other.

Word replacements, phrase rules and the clean-up of a text are done where it is, without a copy of
it per step as a column, and only for the terms that occur in it.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, functions as F

from civiltext import tables
from civiltext.functions import patterns
from civiltext.operators.replacing import RESULT, Replacer, results
from civiltext.operators.termcodes import pieces

_STANDALONE_I = re.compile(r"\bi\b")


def title_case(shout_only: bool) -> Callable[[str], str]:
    """Capitalises every whole word of two or more ASCII letters, or those all in capitals."""
    letters = "A-Z" if shout_only else "A-Za-z" + patterns.CASE_ODD
    words = re.compile(rf"\b[{letters}]{{2,}}\b")
    return lambda text: words.sub(lambda word: word[0].capitalize(), text)


def rule(pattern: str, replacement: str, shout_only: bool) -> Callable[[str], str]:
    """One phrase rule, in any letter case."""
    if replacement == tables.CAPITALIZE:
        return title_case(shout_only)
    # Every second part is the number of a group.
    parts = re.split(r"\\(\d)", replacement)
    parts[::2] = [re.sub(r"\\(.)", r"\1", part, flags=re.S) for part in parts[::2]]
    found = re.compile(pattern, re.I)

    def put(match: re.Match) -> str:
        return "".join(match[int(p)] or "" if i % 2 else p for i, p in enumerate(parts))

    return lambda text: found.sub(put, text)


def clean_up(text: str) -> str:
    """As ``rewriting.final_cleanup``."""
    text = " ".join(text.split())
    if not text:
        return text
    text = text[0].upper() + text[1:]
    return _STANDALONE_I.sub("I", text if text[-1] in ".!?" else text + ".")


class Rewriter:
    """Replaces the terms of a list in its order, then applies the rules in theirs."""

    def __init__(self, ordered: list[tuple[str, str]], rules: list[tuple[str, str]],
                 shout_only: bool = False, clean: bool = False):
        self.ordered, self.rules, self.shout_only, self.clean = ordered, rules, shout_only, clean
        self._made: tuple | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_made": None}

    @property
    def made(self) -> tuple:
        if self._made is None:
            self._made = (Replacer([t for t, _ in self.ordered], [n for _, n in self.ordered]),
                          [rule(*pair, self.shout_only) for pair in self.rules])
        return self._made

    def rewrite(self, text: str) -> tuple[str, list[tuple[str, str]]]:
        """The new text and the terms and rules that changed something."""
        words, rules = self.made
        text, log = words.replace(text)
        for pair, apply in zip(self.rules, rules):
            new = apply(text)
            if new != text:
                log.append(pair)
            text = new
        return clean_up(text) if self.clean else text, log

    def column(self, text: Column) -> Column:
        """A struct of the new text and the changes; null where the text is."""
        def rewrite(texts: pa.Array) -> pa.Array:
            done = [results([None if t is None else self.rewrite(t) for t in piece.to_pylist()])
                    for piece in pieces(texts)]
            return pa.concat_arrays(done) if done else results([])

        rewrite.__annotations__ = {"texts": pa.Array, "return": pa.Array}
        return F.arrow_udf(rewrite, returnType=RESULT)(text)

"""Word replacements given as a table of any size.

The result is that of replacing the terms one after the other, the longest first, each as a whole
word in any letter case, each in the outcome of those before, so that the wording of a replacement
may be replaced in turn. But a text is only touched by the terms that occur in it: an automaton
over all terms finds them, and after each replacement looks again around the places that changed.

A table that was counted and found small is sent to the tasks, and nothing is shuffled. Of a larger
one, each block of texts gets the terms that can come up in it, by joins on the first words of the
terms; the wording of what was found is looked up in turn until nothing is added.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from typing import Iterator as Batches, Tuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from civiltext.functions import patterns
from civiltext.operators.blocks import (BLOCK, ITEM, beside, block_words, looked_up,
                                        looked_up_arrays, with_blocks)
from civiltext.operators.lexicon import replacement_order
from civiltext.operators.lookup import fold
from civiltext.sources.shared import cut_lineage

MAX_ROWS = 500_000
MAX_BYTES = 16 << 20
CHANGES = "array<struct<old:string,new:string>>"
_WORD = re.compile(r"\w")
_FIRST = re.compile(r"\w+|\W")
_WORDS = re.compile(r"\w+")
_PARTS = re.compile(r"(\w+)")
MAX_KEPT = 100_000  # words of texts whose outcome is kept
# Characters that case-insensitive patterns equate in another way than ``fold`` does.
_ODD_CASE = re.compile("[\u0345\u0390\u03b0\u1f80-\u1fff\ufb05\ufb06]")


def _whole_words(text: str, start: int, end: int) -> str:
    """A stretch of a text, with the rest of the words that it cuts."""
    while start > 0 and _WORD.match(text[start - 1]):
        start -= 1
    while end < len(text) and _WORD.match(text[end]):
        end += 1
    return text[start:end]


class Replacer:
    """Replaces the terms of a list, which is in the order of application."""

    def __init__(self, terms: list[str], neutrals: list[str]):
        self.terms, self.neutrals = terms, neutrals

    @cached_property
    def automaton(self):
        import ahocorasick
        found = ahocorasick.Automaton()
        same: dict[str, list[int]] = {}
        for i, term in enumerate(self.terms):
            if term.strip():
                same.setdefault(fold(term), []).append(i)
        for term, numbers in same.items():
            found.add_word(term, (len(term), numbers))
        if len(found):
            found.make_automaton()
        return found

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.terms), default=0)

    @cached_property
    def _patterns(self) -> dict[int, re.Pattern]:
        return {}

    def _pattern(self, number: int) -> re.Pattern:
        if len(self._patterns) > 10_000:
            self._patterns.clear()
        if number not in self._patterns:
            term = self.terms[number]
            before = r"(?<!\w)" if _WORD.match(term[0]) else r"(?<=\w)"
            after = r"(?!\w)" if _WORD.match(term[-1]) else r"(?=\w)"
            self._patterns[number] = re.compile(before + re.escape(term) + after, re.I)
        return self._patterns[number]

    def occurring(self, low: str) -> set[int]:
        """Numbers of the terms that stand in a text, given as ``fold`` makes it, with a word's end
        at both their ends."""
        found = set()
        for last, (size, numbers) in self.automaton.iter(low):
            start = last + 1 - size
            if self._edge(low, start) and self._edge(low, last + 1):
                found.update(numbers)
        return found

    @staticmethod
    def _edge(text: str, at: int) -> bool:
        """Whether a word starts or ends at a place."""
        before = at > 0 and _WORD.match(text[at - 1]) is not None
        return before != (at < len(text) and _WORD.match(text[at]) is not None)

    def _matches(self, number: int, text: str, low: str, plain: bool) -> list[tuple[int, int]]:
        """Where a term stands in a text; without odd letters, no pattern is needed."""
        term = self.terms[number]
        if not plain or _ODD_CASE.search(term):
            return [match.span() for match in self._pattern(number).finditer(text)]
        term, found = fold(term), []
        at, size = low.find(term), len(term)
        while at >= 0:
            whole = self._edge(low, at) and self._edge(low, at + size)
            if whole:
                found.append((at, at + size))
            at = low.find(term, at + (size if whole else 1))
        return found

    @cached_property
    def by_word(self) -> bool:
        """Whether all terms are single words, without odd letters in them or in their wording. No
        replacement then joins two words, so each word of a text comes out as if it stood alone."""
        return all(_WORDS.fullmatch(t) for t in self.terms if t.strip()) and not any(
            map(_ODD_CASE.search, [*self.terms, *self.neutrals]))

    @cached_property
    def _outcomes(self) -> dict[str, tuple[str, list[int]]]:
        return {}

    def replace(self, text: str, made: set[str] | None = None) -> tuple[str, list[tuple[str, str]]]:
        """The new text, and the terms that changed it with their wording; ``made`` takes in the
        words and other characters that stood at changed places meanwhile."""
        if made is None and self.by_word and not _ODD_CASE.search(text):
            text, log = self._word_by_word(text)
        else:
            text, log = self._in_turn(text, made)
        return text, [(self.terms[i], self.neutrals[i]) for i in log]

    def _word_by_word(self, text: str) -> tuple[str, list[int]]:
        parts, log, known, terms = _PARTS.split(text), set(), self._outcomes, self._numbers
        for i in range(1, len(parts), 2):
            word = parts[i]
            if fold(word) not in terms:
                continue
            if word not in known:
                if len(known) >= MAX_KEPT:
                    known.clear()
                known[word] = self._of_word(word)
            parts[i], changed = known[word]
            if changed:
                log.update(changed)
        return "".join(parts), sorted(log)

    @cached_property
    def _numbers(self) -> dict[str, list[int]]:
        """The terms that are a word, by the word."""
        found: dict[str, list[int]] = {}
        for i, term in enumerate(self.terms):
            if term.strip():
                found.setdefault(fold(term), []).append(i)
        return found

    def _of_word(self, word: str) -> tuple[str, list[int]]:
        """``_in_turn`` for a text of one word if all terms are single words: no automaton is made."""
        todo = [*self._numbers[fold(word)]]
        parts, log, queued = ["", word, ""], [], set(todo)
        while todo:
            done = heappop(todo)
            term, neutral = fold(self.terms[done]), self.neutrals[done]
            made, new = _PARTS.split(neutral), [parts[0]]
            for i in range(1, len(parts), 2):
                if fold(parts[i]) != term:
                    new += parts[i:i + 2]
                    continue
                new[-1] += made[0]
                new += made[1:]
                new[-1] += parts[i + 1]
                if parts[i] != neutral and log[-1:] != [done]:
                    log.append(done)
                    for number in {n for w in made[1::2] for n in self._numbers.get(fold(w), ())}:
                        if number > done and number not in queued:
                            queued.add(number)
                            heappush(todo, number)
            parts = new
        return "".join(parts), log

    def _in_turn(self, text: str, made: set[str] | None) -> tuple[str, list[int]]:
        """The new text and the numbers of the terms that changed it, one term after the other."""
        log = []
        if not len(self.automaton):
            return text, log
        low, plain = fold(text), not _ODD_CASE.search(text)
        queued = self.occurring(low)
        todo = [*queued]
        heapify(todo)
        while todo:
            done = heappop(todo)
            neutral = self.neutrals[done]
            low_neutral = fold(neutral)
            parts, lows, places, at, size = [], [], [], 0, 0
            for start, end in self._matches(done, text, low, plain):
                parts += [text[at:start], neutral]
                lows += [low[at:start], low_neutral]
                size += start - at
                places.append((size, size + len(neutral)))
                size, at = size + len(neutral), end
            if not places:
                continue
            new = "".join([*parts, text[at:]])
            if new != text:
                log.append(done)
                low = "".join([*lows, low[at:]])
                plain = plain and not _ODD_CASE.search(neutral)
                for a, b in places:
                    # One character more, to see the words' ends.
                    near = low[max(0, a - self.longest - 1):b + self.longest + 1]
                    for i in self.occurring(near):
                        if i > done and i not in queued:
                            queued.add(i)
                            heappush(todo, i)
                    if made is not None:
                        made.update(_FIRST.findall(fold(_whole_words(new, a, b))))
            text = new
        return text, log


def results(found: list) -> pa.Array:
    """Structs ``text, log`` from pairs; None stays null."""
    logs = [None if f is None else [{"old": a, "new": b} for a, b in f[1]] for f in found]
    kind = pa.list_(pa.struct([("old", pa.string()), ("new", pa.string())]))
    return pa.StructArray.from_arrays(
        [pa.array([f and f[0] for f in found], pa.string()), pa.array(logs, kind)],
        ["text", "log"])


RESULT = f"struct<text:string,log:{CHANGES}>"


def with_replacements(df: DataFrame, col: str, table: DataFrame, out: str) -> DataFrame:
    """Append ``out``, a struct of the new text and the changes; null where the text is.

    ``table`` has ``term, neutral, ord``; of a term listed twice, the last wording counts at the
    place of the first. Terms without any visible character are left out.
    """
    distinct = table.groupBy("term").agg(F.max_by("neutral", "ord").alias("neutral"),
                                         F.min("ord").alias("ord"))
    ordered = cut_lineage(replacement_order(distinct.filter("term IS NOT NULL AND neutral IS NOT NULL"))
                          .select("term", "neutral", "step"))
    octets = F.octet_length("term") + F.octet_length("neutral")
    rows, size = ordered.agg(F.count("*"), F.coalesce(F.sum(octets), F.lit(0))).first()
    if rows <= MAX_ROWS and size <= MAX_BYTES:
        return _in_row(df, col, ordered, out)
    return _by_blocks(df, col, ordered, out)


def _in_row(df: DataFrame, col: str, ordered: DataFrame, out: str) -> DataFrame:
    rows = ordered.orderBy("step").toArrow()
    sent = df.sparkSession.sparkContext.broadcast(
        Replacer(rows["term"].to_pylist(), rows["neutral"].to_pylist()))

    def replace(texts: pa.Array) -> pa.Array:
        return results([None if t is None else sent.value.replace(t) for t in texts.to_pylist()])

    replace.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return df.withColumn(out, F.arrow_udf(replace, returnType=RESULT)(F.col(col)))


def _first_words(text: str) -> set[str]:
    """What a term that stands in a text may start with: its words and other characters."""
    low = fold(text)
    return {*_WORDS.findall(low), *(c for c in set(low) if not _WORD.match(c))}


def _firsts(texts: Column) -> Column:
    def firsts(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(_first_words(t)) if t else [] for t in texts.to_pylist()],
                        pa.list_(pa.string()))

    firsts.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(firsts, returnType="array<string>")(texts)


def _by_blocks(df: DataFrame, col: str, ordered: DataFrame, out: str) -> DataFrame:
    texts, blocks = with_blocks(df, col)
    ordered = ordered.filter(F.col("term").rlike(f"[^{patterns.SPACE}]"))
    # A term starts with a word or another character, the same as the text where it stands.
    starts = cut_lineage(ordered.withColumn("first", F.get(_starts(F.col("term")), F.lit(0))))
    # Terms that end in a word let nothing grow together: what comes up is in their wording.
    edges = f"^[^{patterns.WORD}]|[^{patterns.WORD}]\\z"
    apart = ordered.filter(F.col("term").rlike(edges)).isEmpty()
    new = block_words(texts.filter(F.col(col).isNotNull()), [col], _first_words)
    found = None
    while True:
        # A block has a word once, so no word is a hot key.
        hits = new.join(starts, "first").select(BLOCK, "term", "neutral", "step")
        if found is not None:
            hits = hits.join(found.select(BLOCK, "step"), [BLOCK, "step"], "left_anti")
        hits = cut_lineage(hits)
        if hits.isEmpty():
            break
        found = hits if found is None else found.unionByName(hits)
        new = hits.select(BLOCK, F.explode(_firsts(F.col("neutral"))).alias("first")).distinct() \
            if apart else _made(texts, col, found, blocks)
    if found is None:
        return _in_row(df, col, ordered.limit(0), out)

    def replace(batches):
        yield from looked_up_arrays(batches, _replacing, results)

    replace.__annotations__ = {"batches": Batches[Tuple[pa.Array, ...]], "return": Batches[pa.Array]}
    # It goes by the order of the rows: nothing may be moved past it.
    replaced = F.arrow_udf(replace, returnType=RESULT).asNondeterministic()
    return beside(texts, found, blocks).withColumn(out, replaced(BLOCK, ITEM, col)) \
        .filter(F.col(ITEM).isNull()).drop(BLOCK, ITEM)


def _replacer(listed: list[dict]) -> Replacer:
    listed = sorted(listed, key=lambda r: r["step"])
    return Replacer([r["term"] for r in listed], [r["neutral"] for r in listed])


def _replacing(listed: list[dict]) -> Callable:
    own = _replacer(listed)
    return lambda text: None if text is None else own.replace(text)


def _made(texts: DataFrame, col: str, found: DataFrame, blocks: int) -> DataFrame:
    """What stands at changed places while the terms found for each block are replaced."""
    def made_of(listed: list[dict]) -> Callable:
        own = _replacer(listed)

        def made(number: int, text: str | None) -> tuple[int, set[str]]:
            words: set[str] = set()
            if text is not None:
                own.replace(text, words)
            return number, words
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for done in looked_up((batch.columns for batch in batches), made_of):
            rows = sorted({(number, word) for number, words in filter(None, done) for word in words})
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                              pa.array([r[1] for r in rows], pa.string())],
                                             names=[BLOCK, "first"])

    rows = beside(texts, found, blocks).select(BLOCK, ITEM, F.col(BLOCK).alias("_own"), col)
    return rows.mapInArrow(run, f"{BLOCK} int, first string").distinct()


def _starts(terms: Column) -> Column:
    """The first word, or the first character that is none, of each term."""
    def starts(terms: pa.Array) -> pa.Array:
        return pa.array([_FIRST.findall(fold(t))[:1] for t in terms.to_pylist()],
                        pa.list_(pa.string()))

    starts.__annotations__ = {"terms": pa.Array, "return": pa.Array}
    return F.arrow_udf(starts, returnType="array<string>")(terms)

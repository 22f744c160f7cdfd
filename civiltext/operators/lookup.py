"""Looking a lexicon up in texts, a batch of texts at a time.

Words are looked up in a dictionary, phrases by one Aho-Corasick automaton over all of them, so
the time a text takes depends on its length and hits, not on the size of the lexicon.
"""

from __future__ import annotations

import re
from collections.abc import Collection
from dataclasses import dataclass, field
from functools import cached_property

from civiltext import tables
from civiltext.functions import patterns

_TOKEN = re.compile(f"([^{re.escape(patterns.SPACES)}]+)")
MAX_KEPT = 50_000  # tokens of texts for which what comes of them is kept
_WORD = re.compile(r"\w")
_LAST_WORD = re.compile(r".*\w", re.S)
_ODD = str.maketrans(patterns.CASE_ODD, patterns.CASE_PLAIN)


def fold(text: str) -> str:
    """Letter case taken away, character by character as case-insensitive patterns do it."""
    if text.isascii():
        return text.lower()
    return text.translate(_FOLDED)


class _Folded(dict):
    """By its number, what a character is without letter case; found out when it first comes up."""

    def __missing__(self, code: int) -> str:
        char = chr(code).translate(_ODD)
        low = char.upper().lower()
        self[code] = low if len(low) == 1 else char
        return self[code]


_FOLDED = _Folded()


def escape_html(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


@dataclass
class Marker:
    """Finds tokens that are a term and punctuation around it."""

    longest: int = 0        # of the terms that start or end with punctuation; 0 without any
    _terms: Collection[str] | None = field(default=None, repr=False, compare=False)
    _marked: dict[str, str] = field(default_factory=dict, repr=False, compare=False)
    _folded: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_terms": None, "_marked": {}, "_folded": {}}

    @classmethod
    def of(cls, words) -> "Marker":
        return cls(max((len(t) for t in words
                        if t and not (_WORD.match(t[0]) and _WORD.match(t[-1]))), default=0))

    def candidates(self, token: str):
        """Stretches of a token, as (start, end), that would be marked if they are terms: those
        with as much punctuation as possible left out before them first, longer ones first."""
        first, last = _WORD.search(token), _LAST_WORD.match(token)
        before, after = (first.start(), last.end()) if first else (len(token) - 1, 0)
        for start in range(before, -1 if self.longest else before - 1, -1):
            longest = min(len(token), start + self.longest)
            for end in range(longest, max(after, start), -1):
                yield start, end
            if first and (start == before or after <= longest):
                yield start, after

    def mark(self, text: str, terms) -> str:
        """HTML of a text with the tokens in ``terms`` (folded) marked, the rest escaped."""
        if terms is not self._terms:
            self._terms, self._marked = terms, {}
        parts, marked = _TOKEN.split(text), self._marked
        # A token of letters and digits alone is the only stretch of it.
        for i in range(1, len(parts), 2):
            token = parts[i]
            if token.isalnum():
                if fold(token) in terms:
                    parts[i] = f"{tables.MARK_OPEN}{token}{tables.MARK_CLOSE}"
                continue
            if token not in marked:
                if len(marked) >= MAX_KEPT:
                    marked.clear()
                marked[token] = self._mark_token(token, terms)
            parts[i] = marked[token]
        return "".join(parts)

    def _mark_token(self, token: str, terms) -> str:
        for start, end in self.candidates(token):
            if fold(token[start:end]) in terms:
                return "".join([escape_html(token[:start]), tables.MARK_OPEN,
                                escape_html(token[start:end]), tables.MARK_CLOSE,
                                escape_html(token[end:])])
        return escape_html(token)

    def all_candidates(self, text: str) -> list[str]:
        """What would have to be a term for some token to be marked."""
        tokens, known = set(text.split()), self._folded
        plain = [t for t in tokens if t.isalnum()]
        found = set(fold(" ".join(plain)).split(" ")) if plain else set()
        for token in tokens.difference(plain):
            if token not in known:
                if len(known) >= MAX_KEPT:
                    known.clear()
                known[token] = tuple(fold(token[a:b]) for a, b in self.candidates(token))
            found.update(known[token])
        return list(found)


@dataclass
class LexiconIndex:
    """A lexicon in the memory of a worker; ``terms`` in lexicon order, with their categories."""

    terms: list[str]
    categories: list[str]
    is_phrase: list[bool]

    @cached_property
    def words(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.terms) if not self.is_phrase[i]}

    @cached_property
    def folded(self) -> set[str]:
        return {fold(t) for t in self.words}

    @cached_property
    def marker(self) -> Marker:
        return Marker.of(self.words)

    @cached_property
    def automaton(self):
        import ahocorasick
        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, term in enumerate(self.terms):
            if self.is_phrase[i] and term:
                found.add_word(term, i)
        if len(found):
            found.make_automaton()
        return found

    def phrases_in(self, low: str) -> list[int]:
        """Numbers of the phrases that occur anywhere in a text, in lexicon order."""
        if not low or not len(self.automaton):
            return []
        return sorted({i for _, i in self.automaton.iter(low)})

    def words_in(self, tokens: str) -> list[tuple[int, int]]:
        """Position and number of the tokens (between blanks) that are words of the lexicon."""
        words = self.words
        return [(at, words[w]) for at, w in enumerate(tokens.split(" ")) if w in words]

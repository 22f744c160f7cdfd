"""Regular-expression building blocks.

Word and space characters follow the Unicode rules that comment-cleaning code in Python
relies on. Java's ``\\w``, ``\\s`` and ``\\b`` mean something narrower (ASCII) or slightly
different (``(?U)``), so patterns here spell the classes out.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

WORD = r"\p{L}\p{N}_"
# A class costs a test per member and character, so it has few: all separators, the control
# characters that count as whitespace, and next-line.
SPACE = r"\p{Z}\t-\r\x1c-\x1f\x85"
#: The characters of ``SPACE``, one by one.
SPACES = "".join(c for c in map(chr, range(0x3001))
                 if unicodedata.category(c).startswith("Z") or c in "\t\n\v\f\r\x1c\x1d\x1e\x1f\x85")
NOT_AFTER_WORD = f"(?<![{WORD}])"
NOT_BEFORE_WORD = f"(?![{WORD}])"

# Characters that case-insensitive matching equates with an ASCII letter although
# lower-casing does not: dotted and dotless i, long s, the kelvin sign.
CASE_ODD, CASE_PLAIN = "\u0130\u0131\u017f\u212a", "iisk"

_WORD_RE = re.compile(r"\w")
_CLASSES = {"w": WORD, "s": SPACE, "d": r"\p{Nd}"}


def escape(text: str) -> str:
    """Quote ``text`` for use inside a pattern."""
    return re.escape(text)


def escape_replacement(text: str) -> str:
    """Quote ``text`` for use as a literal replacement."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def any_of(terms: Iterable[str]) -> str:
    """One pattern for all ``terms``, sharing common prefixes.

    Sharing prefixes means a position in the text is tried against a handful of
    first letters and not against every term. Longer terms are preferred.
    """
    tails: dict[str, list[str]] = {}
    for term in terms:
        tails.setdefault(term[:1], []).append(term[1:])
    ends_here = tails.pop("", None) is not None
    branches = [escape(head) + any_of(rest) for head, rest in sorted(tails.items())]
    if not branches:
        return ""
    body = branches[0] if len(branches) == 1 and not ends_here else f"(?:{'|'.join(branches)})"
    return body + ("?" if ends_here else "")


def boundary_before(term: str) -> str:
    """A word boundary directly in front of ``term``."""
    return NOT_AFTER_WORD if _WORD_RE.match(term[0]) else f"(?<=[{WORD}])"


def boundary_after(term: str) -> str:
    """A word boundary directly behind ``term``."""
    return NOT_BEFORE_WORD if _WORD_RE.match(term[-1]) else f"(?=[{WORD}])"


def whole_word(term: str) -> str:
    """``term`` as a whole word, in any letter case."""
    return f"(?iu){boundary_before(term)}{escape(term)}{boundary_after(term)}"


def to_java(pattern: str) -> str:
    """Rewrite ``\\w \\W \\s \\S \\d \\b`` of a Python-style pattern into explicit classes."""
    out, i, in_class = [], 0, False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            if nxt in _CLASSES:
                out.append(_CLASSES[nxt] if in_class else f"[{_CLASSES[nxt]}]")
            elif nxt.lower() in _CLASSES:
                out.append(f"[^{_CLASSES[nxt.lower()]}]")
            elif nxt == "b" and not in_class:
                opens_word = re.match(r"\(?\w", pattern[i + 2:])
                out.append(NOT_AFTER_WORD if opens_word else
                           f"(?:{NOT_AFTER_WORD}(?=[{WORD}])|(?<=[{WORD}]){NOT_BEFORE_WORD})")
            else:
                out.append(ch + nxt)
            i += 2
            continue
        if ch == "[" and not in_class:
            in_class = True
        elif ch == "]":
            in_class = False
        out.append(ch)
        i += 1
    return "".join(out)


def to_java_replacement(template: str) -> str:
    """Rewrite a ``\\1``-style replacement template into the ``$1`` style."""
    quoted = template.replace("$", "\\$")
    return re.sub(r"\\(\d)", r"$\1", quoted)

"""SQL text for expressions with many literals.

A word list as one piece of SQL costs one parse; built up column by column it costs a call
into the JVM per word, which for a lexicon takes longer than scanning a small table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping


def quote(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def is_one_of(name: str, values: Iterable[str]) -> str:
    """``name IN (...)``; false for an empty list."""
    listed = ", ".join(quote(v) for v in values)
    return f"{name} IN ({listed})" if listed else "false"


def map_of(table: Mapping[str, str]) -> str:
    entries = ", ".join(f"{quote(k)}, {quote(v)}" for k, v in table.items())
    return f"map({entries})" if entries else "cast(map() AS map<string,string>)"


def any_contained(name: str, needles: Iterable[str]) -> str:
    """True if column ``name`` contains one of ``needles``; byte scans, no pattern."""
    tests = " OR ".join(f"contains({name}, {quote(n)})" for n in needles)
    return f"({tests})" if tests else "false"


def changes_of(pairs: Iterable[tuple[str, str]]) -> str:
    """A constant change log."""
    entries = ", ".join(f"named_struct('old', {quote(a)}, 'new', {quote(b)})" for a, b in pairs)
    return f"cast(array({entries}) AS array<struct<old:string,new:string>>)"

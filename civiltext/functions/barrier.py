"""Computing columns exactly once.

Spark moves filters below projections by copying the filtered expressions into the filter.
For a text column built in several steps that repeats the work of every step, and inside
``transform`` it repeats it per element. Columns that come out of a generator are not
copied, so expensive ones are passed through ``inline`` of a one-element array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, columns: dict[str, Column], *drop: str) -> DataFrame:
    """Append ``columns``; whatever is done later, each is evaluated once per row."""
    one = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    keep = [c for c in df.columns if c not in columns and c not in drop]
    # The outer form: for the plain one Spark adds a filter that evaluates the array again.
    return df.select(*keep, F.inline_outer(one))


def rows_of(df: DataFrame, keep: list[str], array: Column, not_null: str) -> DataFrame:
    """One row per struct in ``array``, without evaluating the array twice.

    ``not_null`` names a struct field that is never null; it tells the row that stands for
    an empty array from real ones.
    """
    return df.select(*keep, F.inline_outer(array)).filter(F.col(not_null).isNotNull())


def elements_of(df: DataFrame, keep: list[str], array: Column, position: str,
                name: str) -> DataFrame:
    """One row per (never null) element of ``array`` with its position."""
    return (df.select(*keep, F.posexplode_outer(array).alias(position, name))
            .filter(F.col(name).isNotNull()))

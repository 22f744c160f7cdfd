"""What tells rows of a table apart where ids may be missing or repeated."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def row_key(id_col: str, text_col: str) -> Column:
    """A hash of id and text; rows equal in both share it."""
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))

"""Diagnosis-array helpers with 1-based, NULL-on-miss semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dx_at(arr: str | Column, position: int) -> Column:
    """Element at 1-based ``position``; NULL when out of range or NULL array.

    ``get`` is used rather than ``element_at`` because the latter raises on
    out-of-range indexes under ANSI mode.
    """
    if position < 1:
        raise ValueError("positions are 1-based")
    return F.get(_col(arr), position - 1)


def dx_slice(arr: str | Column, start: int, end: int) -> Column:
    """Elements ``start..end`` (1-based, inclusive end); ``[]`` past the end."""
    if start < 1 or end < start:
        raise ValueError("need 1 <= start <= end")
    return F.slice(_col(arr), start, end - start + 1)


def code_prefixes(code: str | Column) -> Column:
    """All prefixes of a code, from the empty string to the code itself.

    Lets a prefix match (``code LIKE 'p%'``) run as an equi-join.
    """
    c = _col(code)
    return F.transform(F.sequence(F.lit(0), F.length(c)), lambda k: F.substring(c, 1, k))

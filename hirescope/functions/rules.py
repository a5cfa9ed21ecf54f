"""Ordered rule lists compiled into a single CASE expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def first_match(rules: Iterable[tuple[Column, object]], default=None) -> Column:
    """``CASE WHEN p1 THEN v1 WHEN p2 THEN v2 ... ELSE default END``.

    The first predicate that is true wins; a NULL predicate counts as false,
    exactly as in SQL.
    """
    expr = None
    for predicate, value in rules:
        expr = F.when(predicate, _as_col(value)) if expr is None else expr.when(predicate, _as_col(value))
    if expr is None:
        return _as_col(default)
    return expr.otherwise(_as_col(default)) if default is not None else expr


def contains_any(col: Column, needles: Iterable[str]) -> Column:
    """True when ``col`` contains any needle (``LIKE '%needle%' OR ...``)."""
    pred = None
    for needle in needles:
        p = col.contains(needle)
        pred = p if pred is None else (pred | p)
    return pred

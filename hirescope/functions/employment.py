"""Employment-type normalisation for feed A."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Squashed spelling -> enum label.
EMPLOYMENT_ENUM = [
    ("fulltime", "FULL_TIME"),
    ("parttime", "PART_TIME"),
    ("contract", "CONTRACT"),
    ("internship", "INTERNSHIP"),
    ("temporary", "TEMPORARY"),
    ("volunteer", "VOLUNTEER"),
]


def normalise_employment_type(col: Column, mode: str = "reference") -> Column:
    """Map an employment type to an enum label, else upper-case it.

    ``mode="reference"`` strips every character outside ``[a-z]`` *before*
    lower-casing, so ``Full-time`` squashes to ``ulltime`` and stays
    ``FULL-TIME``; ``mode="fixed"`` lower-cases first.
    """
    if mode == "reference":
        squashed = F.lower(F.regexp_replace(col, "[^a-z]", ""))
    elif mode == "fixed":
        squashed = F.regexp_replace(F.lower(col), "[^a-z]", "")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    # one literal-map lookup: the squashed text is computed once per row
    enum = F.create_map(*[F.lit(x) for pair in EMPLOYMENT_ENUM for x in pair])
    return F.when(col.isNull() | (F.trim(col) == F.lit("")), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.try_element_at(enum, squashed), F.upper(col))
    )

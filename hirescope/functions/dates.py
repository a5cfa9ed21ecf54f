"""Date handling. Dates travel as ``yyyy-MM-dd`` strings and are parsed once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MILLIS_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
DAY_FORMAT = "yyyy-MM-dd"


def posted_date_from_timestamp_text(col: Column) -> Column:
    """Feed A: any timestamp-shaped text -> ``yyyy-MM-dd`` (NULL if malformed)."""
    return F.date_format(F.to_date(col.try_cast("timestamp")), DAY_FORMAT)


def posted_date_from_iso(col: Column) -> Column:
    """Feed B: ``yyyy-MM-dd'T'HH:mm:ss.SSS'Z'`` -> ``yyyy-MM-dd`` (NULL if malformed)."""
    return F.date_format(F.try_to_date(col, ISO_MILLIS_UTC), DAY_FORMAT)


def as_date(col: Column) -> Column:
    """Parse a ``yyyy-MM-dd`` string once; malformed text becomes NULL."""
    return col.try_cast("date")


def date_lit(as_of: dt.date | str) -> Column:
    return F.lit(str(as_of)).cast("date")


def posted_on_or_after(posted: Column, as_of: dt.date | str, days: int) -> Column:
    """``posted >= as_of - days`` on a parsed date column."""
    return posted >= F.date_sub(date_lit(as_of), days)

"""Union of the two cleaned feeds, and of their descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import schemas
from .incremental import since


def unify(
    cleaned_b: DataFrame,
    cleaned_a: DataFrame,
    target: DataFrame | None = None,
    columns: list[str] = schemas.UNIFIED_COLUMNS,
) -> DataFrame:
    """``UNION ALL`` by name of 20 columns (feed B first);
    ``columns=schemas.LEGACY_UNIFIED_COLUMNS`` gives the older 18-column union.

    Incremental runs keep rows with ``ingest_dts`` above the target's maximum
    with no floor: against an empty target nothing is loaded.
    """
    new = lambda df: since(df, target, "ingest_dts", floor=None, partition=("year", "month", "day")).select(*columns)
    return new(cleaned_b).unionByName(new(cleaned_a))


DESCRIPTION_COLUMNS = ["job_posting_id", "job_summary", "scraped_dts"]


def descriptions(
    cleaned_b: DataFrame,
    cleaned_a: DataFrame,
    target: DataFrame | None = None,
    filter_both: bool = False,
) -> DataFrame:
    """Posting descriptions from both feeds.

    In an incremental run the ``scraped_dts`` filter applies to the feed A
    branch only (feed B is re-merged every run); ``filter_both=True``
    filters both branches.
    """
    b = cleaned_b.select(*DESCRIPTION_COLUMNS)
    a = cleaned_a.select(*DESCRIPTION_COLUMNS)
    if target is not None:
        a = since(a, target, "scraped_dts")
        if filter_both:
            b = since(b, target, "scraped_dts")
    return b.unionByName(a)

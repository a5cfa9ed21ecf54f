"""Availability and AI-summary side tables, and the enrichment join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import as_of_timestamp, load_date_parts
from .incremental import high_water_mark, since

# Fixed value: the text that marks a missing seniority or salary.
NOT_APPLICABLE = "Not Applicable"


def load_availability(raw: DataFrame, as_of, target: DataFrame | None = None) -> DataFrame:
    """Typed availability rows plus load-date partitions.

    The flag may be text: ``true``/``1``/``yes`` and ``false``/``0``/``no``
    convert, anything else is NULL (see ``unreadable_flags``)."""
    df = raw.select(
        F.col("job_posting_id").cast("string").alias("job_posting_id"),
        F.col("is_active").try_cast("boolean").alias("is_active"),
        F.col("validated_dts"),
    ).withColumns(load_date_parts(as_of))
    return since(df, target, "validated_dts")


def unreadable_flags(raw: DataFrame) -> DataFrame:
    """Pool rows whose flag is text that is no boolean: they load with a NULL
    flag, so a report of them belongs beside the load."""
    return raw.where(F.col("is_active").isNotNull() & F.col("is_active").try_cast("boolean").isNull())


SUMMARY_COLUMNS = [
    "job_posting_id", "job_seniority_level", "workplace_type", "min_salary",
    "max_salary", "it_domains", "ai_summaries", "summarized_dts",
]


def load_ai_summaries(raw: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return since(raw.select(*SUMMARY_COLUMNS), target, "summarized_dts")


def _missing(col: Column, dtype: T.DataType) -> Column:
    """NULL, or the text 'Not Applicable' when the column is a string.

    On a numeric column the text test can never hold (and would be a cast
    error under ANSI), so only the NULL test is kept.
    """
    if isinstance(dtype, T.StringType):
        return col.isNull() | (col == F.lit(NOT_APPLICABLE))
    return col.isNull()


def enriched_seniority(source: Column, own: Column, ai: Column, dtype: T.DataType) -> Column:
    """Feed A takes the summary's value first; feed B only when its own is missing."""
    return (
        F.when(source == 0, F.coalesce(ai, own))
        .when(_missing(own, dtype), F.coalesce(ai, own))
        .otherwise(own)
    )


def enriched_salary(own: Column, ai: Column, dtype: T.DataType) -> Column:
    return F.when(_missing(own, dtype), F.coalesce(ai, own)).otherwise(own)


def enrich(
    unified: DataFrame,
    availability: DataFrame,
    summaries: DataFrame,
    as_of,
    target: DataFrame | None = None,
    reprocess_on_change: bool = False,
) -> DataFrame:
    """Unified postings left-joined to availability, then to AI summaries.

    Both joins are on ``job_posting_id``; after the first sort-merge join the
    rows are already hash-partitioned on that key, so the second join does
    not shuffle the postings again.  Only rows not yet enriched are taken;
    an incremental run keeps postings ingested after the target's latest
    enrichment time (no floor).  That never revisits a posting whose
    availability or summary arrives later; ``reprocess_on_change=True`` also
    takes postings whose availability check or summary is newer than the
    last enrichment.

    ``availability`` and ``summaries`` hold one row per posting (as the
    merged side tables do; ``latest_per_key`` gives that for raw input),
    otherwise a posting would be repeated once per match.
    """
    ju = unified.where(F.col("is_enriched") == F.lit(False))
    if target is not None and not reprocess_on_change:
        ju = since(ju, target, "ingest_dts", "enriched_dts", floor=None, partition="load_date")
    elif target is not None:
        hwm = high_water_mark(target, "enriched_dts", floor=None)
        # the few postings whose side rows changed are found first; only they and new postings are joined
        changed = (
            availability.where(F.col("validated_dts") > hwm).select("job_posting_id")
            .union(summaries.where(F.col("summarized_dts") > hwm).select("job_posting_id"))
            .distinct()
        )
        again = ju.where(F.col("ingest_dts") <= hwm).join(changed, "job_posting_id", "left_semi").select(*ju.columns)
        ju = since(ju, target, "ingest_dts", "enriched_dts", floor=None, partition="load_date").unionByName(again)
    jia = availability.select("job_posting_id", F.col("is_active").alias("_avail_active"))
    jas = summaries.select(
        "job_posting_id",
        F.col("job_seniority_level").alias("_ai_seniority"),
        "workplace_type",
        F.col("min_salary").alias("_ai_min_salary"),
        F.col("max_salary").alias("_ai_max_salary"),
        "it_domains",
        "ai_summaries",
    )
    types = {f.name: f.dataType for f in unified.schema.fields}
    j = ju.join(jia, "job_posting_id", "left").join(jas, "job_posting_id", "left")
    return j.select(
        "url", "job_posting_id", "job_title", "company_name", "job_city", "job_state", "job_country",
        enriched_seniority(
            F.col("job_source"), F.col("job_seniority_level"), F.col("_ai_seniority"),
            types["job_seniority_level"],
        ).alias("job_seniority_level"),
        "job_function", "job_employment_type", "job_industries",
        enriched_salary(F.col("min_salary"), F.col("_ai_min_salary"), types["min_salary"]).alias("min_salary"),
        enriched_salary(F.col("max_salary"), F.col("_ai_max_salary"), types["max_salary"]).alias("max_salary"),
        "job_posted_date", "scraped_dts", "ingest_dts", "_rescued_data",
        F.lit(True).alias("is_enriched"),
        as_of_timestamp(as_of).alias("enriched_dts"),
        "job_source",
        F.coalesce(F.col("_avail_active"), F.col("is_active")).alias("is_active"),
        "workplace_type", "it_domains", "ai_summaries",
    )

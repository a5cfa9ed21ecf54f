"""Gold staging: active postings only, renamed URL, audit stamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..sources.files import as_of_timestamp
from .incremental import since


def stage_active(enriched: DataFrame, as_of, target: DataFrame | None = None) -> DataFrame:
    """Keep active postings (a NULL flag is not active) and add audit columns.

    A posting that later turns inactive is filtered out of the batch, so an
    upsert never removes it from an existing staging table (reference
    behaviour).
    """
    now = as_of_timestamp(as_of)
    df = enriched.where(F.col("is_active"))
    df = since(df, target, "enriched_dts", partition="load_date")
    return df.select(
        "job_posting_id",
        F.col("url").alias("job_url"),
        "job_title", "company_name", "job_city", "job_state", "job_country",
        "job_seniority_level", "job_function", "job_posted_date", "job_employment_type",
        "job_industries", "scraped_dts", "ingest_dts", "_rescued_data", "min_salary", "max_salary",
        F.coalesce(F.col("is_enriched"), F.lit(False)).alias("is_enriched"),
        F.coalesce(F.col("is_active"), F.lit(False)).alias("is_active"),
        "job_source", "enriched_dts",
        now.alias("dbt_created_at"),
        now.alias("dbt_updated_at"),
    ).select(*schemas.STAGED_COLUMNS)


def inactive_keys(enriched: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Keys of postings in the batch that are no longer active (NULL counts
    as inactive): the rows to remove from staging when that option is on."""
    batch = since(enriched, target, "enriched_dts", partition="load_date")
    return batch.where(~F.coalesce(F.col("is_active"), F.lit(False))).select("job_posting_id")

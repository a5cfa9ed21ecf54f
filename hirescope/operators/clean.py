"""Silver cleaning of the two raw feeds (location, employment type, dates, salary)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import (
    normalise_employment_type,
    parse_city,
    parse_country,
    parse_state,
    posted_date_from_iso,
    posted_date_from_timestamp_text,
)
from ..sources.files import load_date_parts
from .incremental import since

SOURCE_ID = {"a": 0, "b": 1}


def location_columns(df: DataFrame, location: str = "job_location") -> DataFrame:
    """Add ``job_city``, ``job_state`` and ``job_country`` parsed from the location."""
    loc = F.col(location)
    return df.withColumns(
        {"job_city": parse_city(loc), "job_state": parse_state(loc), "job_country": parse_country(loc)}
    )


def salary_bounds(df: DataFrame, feed: str) -> DataFrame:
    """``min_salary``/``max_salary`` from flat columns (A) or the struct (B)."""
    if feed == "a":
        return df.withColumns({"min_salary": F.col("MIN_AMOUNT"), "max_salary": F.col("MAX_AMOUNT")})
    return df.withColumns(
        {"min_salary": F.col("base_salary.min_amount"), "max_salary": F.col("base_salary.max_amount")}
    )


def posted_date(df: DataFrame, feed: str) -> DataFrame:
    parse = posted_date_from_timestamp_text if feed == "a" else posted_date_from_iso
    return df.withColumn("job_posted_date", parse(F.col("job_posted_date")))


def employment_type(df: DataFrame, feed: str, mode: str = "reference") -> DataFrame:
    """Feed A is normalised to enum labels; feed B passes through unchanged."""
    if feed == "a":
        return df.withColumn("job_employment_type", normalise_employment_type(F.col("job_employment_type"), mode))
    return df


def tag_source(df: DataFrame, feed: str) -> DataFrame:
    return df.withColumns(
        {
            "is_enriched": F.lit(False),
            "job_source": F.lit(SOURCE_ID[feed]),
            "is_active": F.lit(True),
        }
    )


def clean_feed(
    bronze: DataFrame,
    feed: str,
    as_of,
    target: DataFrame | None = None,
    employment_mode: str = "reference",
) -> DataFrame:
    """Bronze feed -> cleaned silver rows (25 columns).

    ``target`` is the existing cleaned table for an incremental run: only
    rows whose ``ingest_dts`` is newer than its maximum are kept.
    Partition columns come from the load date ``as_of``.
    """
    if feed not in SOURCE_ID:
        raise ValueError(f"unknown feed {feed!r}")
    df = since(bronze, target, "ingest_dts", partition=("year", "month", "day"))
    df = location_columns(df)
    df = employment_type(df, feed, employment_mode)
    df = salary_bounds(df, feed)
    df = posted_date(df, feed)
    df = df.withColumn("scraped_dts", F.col("timestamp"))
    df = tag_source(df, feed)
    df = df.withColumns(load_date_parts(as_of))
    return df.select(*schemas.CLEANED_COLUMNS)


def clean_feed_legacy(bronze: DataFrame, feed: str, as_of, target: DataFrame | None = None) -> DataFrame:
    """Older cleaning variant: no location parsing, no enum, integer flags.

    Its incremental filter compares the raw event time with the target's
    latest ingest time.
    """
    df = since(bronze, target, "timestamp", "ingest_dts")
    df = salary_bounds(df, feed)
    df = posted_date(df, feed)
    df = df.withColumns(
        {
            "scraped_dts": F.col("timestamp"),
            "is_enriched": F.lit(0),
            "job_source": F.lit(SOURCE_ID[feed]),
            "is_active": F.lit(1),
        }
    ).withColumns(load_date_parts(as_of))
    return df.select(
        "url", "job_posting_id", "job_title", "company_name", "job_location", "job_summary",
        "job_seniority_level", "job_function", "job_employment_type", "job_industries",
        "min_salary", "max_salary", "job_posted_date", "scraped_dts", "ingest_dts",
        "_rescued_data", "is_enriched", "job_source", "is_active", "year", "month", "day",
    )

"""Explicit schemas of the raw feeds and side tables, plus table settings.

Raw files are never schema-inferred: each feed has a fixed StructType and
anything that does not fit lands in ``_rescued_data``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_COMMON_HEAD = [
    T.StructField("url", T.StringType()),
    T.StructField("job_posting_id", T.StringType()),
    T.StructField("job_title", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("job_location", T.StringType()),
    T.StructField("job_summary", T.StringType()),
    T.StructField("job_seniority_level", T.StringType()),
    T.StructField("job_function", T.StringType()),
    T.StructField("job_employment_type", T.StringType()),
    T.StructField("job_industries", T.StringType()),
    T.StructField("job_posted_date", T.StringType()),
]

# Feed A: salary as two flat columns (job_source = 0).
RAW_FEED_A = T.StructType(
    _COMMON_HEAD
    + [
        T.StructField("MIN_AMOUNT", T.DoubleType()),
        T.StructField("MAX_AMOUNT", T.DoubleType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("_rescued_data", T.StringType()),
    ]
)

SALARY_STRUCT = T.StructType(
    [T.StructField("min_amount", T.DoubleType()), T.StructField("max_amount", T.DoubleType())]
)

# Feed B: salary nested in a struct, posted date as ISO text (job_source = 1).
RAW_FEED_B = T.StructType(
    _COMMON_HEAD
    + [
        T.StructField("base_salary", SALARY_STRUCT),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("_rescued_data", T.StringType()),
    ]
)

AVAILABILITY_CSV = T.StructType(
    [
        T.StructField("job_posting_id", T.StringType()),
        T.StructField("is_active", T.StringType()),
        T.StructField("validated_dts", T.TimestampType()),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

AI_SUMMARIES = T.StructType(
    [
        T.StructField("job_posting_id", T.StringType()),
        T.StructField("job_seniority_level", T.StringType()),
        T.StructField("workplace_type", T.StringType()),
        T.StructField("min_salary", T.DoubleType()),
        T.StructField("max_salary", T.DoubleType()),
        T.StructField("it_domains", T.StringType()),
        T.StructField("ai_summaries", T.StringType()),
        T.StructField("summarized_dts", T.TimestampType()),
    ]
)

# Column order of the cleaned (silver) feeds.
CLEANED_COLUMNS = [
    "url", "job_posting_id", "job_title", "company_name", "job_location",
    "job_city", "job_state", "job_country", "job_summary", "job_seniority_level",
    "job_function", "job_employment_type", "job_industries", "min_salary",
    "max_salary", "job_posted_date", "scraped_dts", "ingest_dts", "_rescued_data",
    "is_enriched", "job_source", "is_active", "year", "month", "day",
]

# The unified table drops the raw location and the free-text summary.
UNIFIED_COLUMNS = [
    "url", "job_posting_id", "job_title", "company_name", "job_city", "job_state",
    "job_country", "job_seniority_level", "job_function", "job_employment_type",
    "job_industries", "min_salary", "max_salary", "job_posted_date", "scraped_dts",
    "ingest_dts", "_rescued_data", "is_enriched", "job_source", "is_active",
]

# Older model tree: the union keeps the raw location and has no parsed parts.
LEGACY_UNIFIED_COLUMNS = [
    "url", "job_posting_id", "job_title", "company_name", "job_location", "job_seniority_level",
    "job_function", "job_employment_type", "job_industries", "min_salary", "max_salary",
    "job_posted_date", "scraped_dts", "ingest_dts", "_rescued_data", "is_enriched", "job_source",
    "is_active",
]

STAGED_COLUMNS = [
    "job_posting_id", "job_url", "job_title", "company_name", "job_city", "job_state",
    "job_country", "job_seniority_level", "job_function", "job_posted_date",
    "job_employment_type", "job_industries", "scraped_dts", "ingest_dts",
    "_rescued_data", "min_salary", "max_salary", "is_enriched", "is_active",
    "job_source", "enriched_dts", "dbt_created_at", "dbt_updated_at",
]


@dataclass(frozen=True)
class TableSpec:
    """How a table is maintained: merge key, high-water mark, partitions, format.

    ``derived`` adds storage-only partition columns (name, SQL expression;
    ``{as_of}`` is replaced by the run's load date) to tables whose shape has
    none, so merges can stay partition-limited; they are dropped again when
    the table is read.
    """

    key: tuple[str, ...] = ("job_posting_id",)
    watermark: str | None = None
    partitions: tuple[str, ...] = field(default_factory=tuple)
    format: str = "parquet"
    derived: tuple[tuple[str, str], ...] = field(default_factory=tuple)


def _by_day_of(column: str) -> dict:
    """Partition by the day of a load-time column (one partition per load)."""
    return {"partitions": ("load_date",), "derived": (("load_date", f"CAST(to_date({column}) AS STRING)"),)}


BRONZE = TableSpec(watermark="timestamp", partitions=("year", "month", "day"))
CLEANED = TableSpec(watermark="ingest_dts", partitions=("year", "month", "day"))
UNIFIED = TableSpec(watermark="ingest_dts", **_by_day_of("ingest_dts"))
def _by_load() -> dict:
    """Partition by the run's load date (for tables whose only time column is
    an event time, which would give one partition per event day)."""
    return {"partitions": ("load_date",), "derived": (("load_date", "'{as_of}'"),)}


DESCRIPTIONS = TableSpec(watermark="scraped_dts", **_by_load())
AVAILABILITY = TableSpec(watermark="validated_dts", partitions=("year", "month", "day"))
SUMMARIES = TableSpec(watermark="summarized_dts", **_by_load())
ENRICHED = TableSpec(watermark="enriched_dts", **_by_day_of("enriched_dts"))
STAGED = TableSpec(watermark="enriched_dts", **_by_day_of("enriched_dts"))

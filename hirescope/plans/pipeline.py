"""The bronze -> silver -> gold chain over postings derived from the driver tables.

Each function is lazy: it only builds the Catalyst plan.  Nothing here is
collected; the caller writes or collects the final DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean_feed, enrich, load_ai_summaries, load_availability, stage_active, unify
from ..sources import fixtures
from ..sources.files import bronze_stamp


@dataclass
class Silver:
    cleaned_a: DataFrame
    cleaned_b: DataFrame
    unified: DataFrame
    availability: DataFrame
    summaries: DataFrame
    enriched: DataFrame
    staged: DataFrame


def bronze_feeds(spark: SparkSession, sf_dir: str, as_of=fixtures.AS_OF) -> tuple[DataFrame, DataFrame]:
    posts = fixtures.postings(spark, sf_dir, as_of)
    a = bronze_stamp(fixtures.raw_feed_a(posts), as_of, with_file_path=False)
    b = bronze_stamp(fixtures.raw_feed_b(posts), as_of, with_file_path=False)
    return a, b


def cleaned_feeds(spark: SparkSession, sf_dir: str, as_of=fixtures.AS_OF, employment_mode: str = "reference"):
    a, b = bronze_feeds(spark, sf_dir, as_of)
    return clean_feed(a, "a", as_of, employment_mode=employment_mode), clean_feed(b, "b", as_of)


def silver(spark: SparkSession, sf_dir: str, as_of=fixtures.AS_OF) -> Silver:
    """The silver chain as lazy plans."""
    ca, cb = cleaned_feeds(spark, sf_dir, as_of)
    unified = unify(cb, ca)
    avail = load_availability(fixtures.availability(spark, sf_dir), as_of)
    summaries = load_ai_summaries(fixtures.ai_summaries(spark, sf_dir))
    enriched = enrich(unified, avail, summaries, as_of)
    staged = stage_active(enriched, as_of)
    return Silver(ca, cb, unified, avail, summaries, enriched, staged)


def staged_postings(spark: SparkSession, sf_dir: str, as_of=fixtures.AS_OF) -> DataFrame:
    return silver(spark, sf_dir, as_of).staged

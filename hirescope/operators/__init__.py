"""DataFrame -> DataFrame operators."""

from .clean import clean_feed, clean_feed_legacy, location_columns
from .unify import unify, descriptions
from .enrich import enrich, load_availability, load_ai_summaries, unreadable_flags
from .stage import stage_active
from .geo import geocode
from .incremental import since, high_water_mark, latest_per_key, matching, upsert
from .marts import heatmap, company_mart, skills_mart, geo_mart

__all__ = [
    "clean_feed",
    "clean_feed_legacy",
    "location_columns",
    "unify",
    "descriptions",
    "enrich",
    "load_availability",
    "load_ai_summaries",
    "unreadable_flags",
    "stage_active",
    "geocode",
    "since",
    "high_water_mark",
    "latest_per_key",
    "matching",
    "upsert",
    "heatmap",
    "company_mart",
    "skills_mart",
    "geo_mart",
]

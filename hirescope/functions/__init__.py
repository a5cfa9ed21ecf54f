"""Column-level rules (pure ``Column -> Column`` builders, all JVM-side)."""

from .rules import first_match
from .location import parse_city, parse_state, parse_country
from .employment import normalise_employment_type
from .dates import posted_date_from_timestamp_text, posted_date_from_iso, posted_on_or_after, as_date
from .classify import (
    standardise_seniority,
    tech_skill_category,
    cloud_platform_focus,
    primary_language_hint,
    is_tech_function,
)

__all__ = [
    "first_match",
    "parse_city",
    "parse_state",
    "parse_country",
    "normalise_employment_type",
    "posted_date_from_timestamp_text",
    "posted_date_from_iso",
    "posted_on_or_after",
    "as_date",
    "standardise_seniority",
    "tech_skill_category",
    "cloud_platform_focus",
    "primary_language_hint",
    "is_tech_function",
]

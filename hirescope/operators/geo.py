"""Geocoding of staged postings against the inline city dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import distance_from_sydney_km, mid_salary
from ..sources.dimensions import COUNTRY_CENTRE, STATE_CENTRES, city_dimension

GEO_COLUMNS = [
    "job_posting_id", "job_title", "company_name", "job_city", "job_state",
    "job_seniority_level", "job_function", "job_industries", "job_employment_type",
    "job_posted_date", "min_salary", "max_salary",
]


def _state_default(state: Column, index: int, fallback: float) -> Column:
    expr = None
    for code, point in STATE_CENTRES.items():
        expr = F.when(state == code, F.lit(point[index])) if expr is None else expr.when(
            state == code, F.lit(point[index])
        )
    return expr.otherwise(F.lit(fallback))


def geocode(staged: DataFrame) -> DataFrame:
    """Latitude, longitude, tier and distance from Sydney for each posting.

    Left join on ``lower(trim(city)) = lower(city_name) AND state = code``.
    The dimension has a fixed 37 rows, so it is broadcast and the postings
    are never shuffled.  Unmatched postings fall back to their state's point,
    then the country centre; their distance is computed from Sydney itself
    (0 km), as in the reference.
    """
    cities = F.broadcast(
        city_dimension(staged.sparkSession).select(
            F.lower(F.col("city_name")).alias("_city_key"),
            F.col("state_code").alias("_state_key"),
            F.col("latitude").alias("_lat"),
            F.col("longitude").alias("_lon"),
            F.col("city_tier").alias("_tier"),
        )
    )
    j = staged.select(*GEO_COLUMNS).join(
        cities,
        (F.lower(F.trim(F.col("job_city"))) == F.col("_city_key")) & (F.col("job_state") == F.col("_state_key")),
        "left",
    )
    state = F.col("job_state")
    return j.select(
        *GEO_COLUMNS,
        mid_salary(F.col("min_salary"), F.col("max_salary")).alias("mid_salary"),
        F.coalesce(F.col("_lat"), _state_default(state, 0, COUNTRY_CENTRE[0])).alias("latitude"),
        F.coalesce(F.col("_lon"), _state_default(state, 1, COUNTRY_CENTRE[1])).alias("longitude"),
        F.coalesce(F.col("_tier"), F.lit("Unknown")).alias("city_tier"),
        distance_from_sydney_km(F.col("_lat"), F.col("_lon")).alias("distance_from_sydney_km"),
    )

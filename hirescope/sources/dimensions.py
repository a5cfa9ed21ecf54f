"""Inline 37-row city dimension and state/country fallback points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed values (must equal the reference's for identical results):
# city, state code, latitude, longitude, tier.
CITIES = [
    ("Sydney", "NSW", -33.8688, 151.2093, "Major"),
    ("Melbourne", "VIC", -37.8136, 144.9631, "Major"),
    ("Brisbane", "QLD", -27.4698, 153.0251, "Major"),
    ("Perth", "WA", -31.9505, 115.8605, "Major"),
    ("Adelaide", "SA", -34.9285, 138.6007, "Major"),
    ("Canberra", "ACT", -35.2809, 149.1300, "Major"),
    ("Darwin", "NT", -12.4634, 130.8456, "Major"),
    ("Hobart", "TAS", -42.8821, 147.3272, "Major"),
    ("Gold Coast", "QLD", -28.0167, 153.4000, "Secondary"),
    ("Newcastle", "NSW", -32.9283, 151.7817, "Secondary"),
    ("Wollongong", "NSW", -34.4278, 150.8931, "Secondary"),
    ("Sunshine Coast", "QLD", -26.6500, 153.0667, "Secondary"),
    ("Geelong", "VIC", -38.1499, 144.3617, "Secondary"),
    ("Townsville", "QLD", -19.2590, 146.8169, "Secondary"),
    ("Cairns", "QLD", -16.9186, 145.7781, "Secondary"),
    ("Toowoomba", "QLD", -27.5598, 151.9507, "Secondary"),
    ("Ballarat", "VIC", -37.5622, 143.8503, "Secondary"),
    ("Bendigo", "VIC", -36.7570, 144.2794, "Secondary"),
    ("Albury", "NSW", -36.0737, 146.9135, "Secondary"),
    ("Launceston", "TAS", -41.4332, 147.1441, "Secondary"),
    ("Mackay", "QLD", -21.1550, 149.1613, "Secondary"),
    ("Rockhampton", "QLD", -23.3781, 150.5069, "Secondary"),
    ("Bunbury", "WA", -33.3267, 115.6411, "Secondary"),
    ("Bundaberg", "QLD", -24.8661, 152.3489, "Secondary"),
    ("Wagga Wagga", "NSW", -35.1082, 147.3598, "Secondary"),
    ("North Sydney", "NSW", -33.8403, 151.2065, "Suburb"),
    ("Surry Hills", "NSW", -33.8886, 151.2094, "Suburb"),
    ("Parramatta", "NSW", -33.8150, 151.0010, "Suburb"),
    ("Baulkham Hills", "NSW", -33.7581, 150.9876, "Suburb"),
    ("Dee Why", "NSW", -33.7581, 151.2886, "Suburb"),
    ("Millers Point", "NSW", -33.8569, 151.2055, "Suburb"),
    ("Glen Waverley", "VIC", -37.8770, 145.1608, "Suburb"),
    ("Mulgrave", "VIC", -37.9262, 145.1431, "Suburb"),
    ("Footscray", "VIC", -37.7993, 144.9009, "Suburb"),
    ("Bundoora", "VIC", -37.7004, 145.0581, "Suburb"),
    ("Virginia", "SA", -34.6667, 138.5500, "Regional"),
    ("No Regrets", "QLD", -27.4698, 153.0251, "Special"),
]
# Fallback point per state code, and the country centre.
STATE_CENTRES = {
    "NSW": (-33.8688, 151.2093),
    "VIC": (-37.8136, 144.9631),
    "QLD": (-27.4698, 153.0251),
    "WA": (-31.9505, 115.8605),
    "SA": (-34.9285, 138.6007),
    "ACT": (-35.2809, 149.1300),
    "NT": (-12.4634, 130.8456),
    "TAS": (-42.8821, 147.3272),
}
COUNTRY_CENTRE = (-25.2744, 133.7751)

CITY_SCHEMA = T.StructType(
    [
        T.StructField("city_name", T.StringType(), False),
        T.StructField("state_code", T.StringType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("city_tier", T.StringType(), False),
    ]
)


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def city_dimension(spark: SparkSession) -> DataFrame:
    """The 37-row dimension as an inline relation (planned as a local
    relation, no job to build it); its size is fixed, so it is safe to
    broadcast."""
    rows = ", ".join(
        f"({_sql_text(c)}, {_sql_text(s)}, CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE), {_sql_text(t)})"
        for c, s, lat, lon, t in CITIES
    )
    names = ", ".join(f.name for f in CITY_SCHEMA.fields)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS cities({names})")

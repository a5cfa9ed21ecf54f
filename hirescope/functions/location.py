"""Location parsing: city, state code and country from free-text locations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import first_match

# Fixed values (must equal the reference's for identical results).
# Locations that name only a state; they carry no city.
STATE_ONLY_LOCATIONS = [
    "Queensland, Australia",
    "Victoria, Australia",
    "New South Wales, Australia",
    "Tasmania, Australia",
    "Northern Territory, Australia",
    "Australian Capital Territory, Australia",
    "Western Australia, Australia",
    "South Australia, Australia",
]
# State codes, in the order they are tested as ", CODE, " patterns.
STATE_CODES = ["VIC", "NSW", "QLD", "SA", "WA", "TAS", "NT", "ACT"]
# Full state names, in the order they are tested as substrings.
STATE_NAMES = [
    ("Victoria", "VIC"),
    ("New South Wales", "NSW"),
    ("Queensland", "QLD"),
    ("Western Australia", "WA"),
    ("South Australia", "SA"),
    ("Tasmania", "TAS"),
    ("Northern Territory", "NT"),
    ("Australian Capital Territory", "ACT"),
]
GREATER_AREA_PATTERN = "Greater (.*) Area"
CODE_THEN_AU_PATTERN = ", (VIC|NSW|QLD|SA|WA|TAS|NT|ACT), AU"
COUNTRY_CODE = "AU"


def _first_part(loc: Column) -> Column:
    return F.split(loc, ",").getItem(0)


def parse_city(loc: Column) -> Column:
    """City or suburb from a location string (first matching rule wins)."""
    state_only = loc.isin(STATE_ONLY_LOCATIONS)
    return first_match(
        [
            (loc.like("%Greater % Area%"), F.regexp_extract(loc, GREATER_AREA_PATTERN, 1)),
            (loc.like("% Area"), F.trim(F.replace(loc, F.lit("Area"), F.lit("")))),
            # kept untrimmed on purpose: the geocoder trims its own side
            (loc.rlike(CODE_THEN_AU_PATTERN), _first_part(loc)),
            (state_only, F.lit(None).cast("string")),
            (loc.like("%,%"), F.trim(_first_part(loc))),
        ]
    )


def parse_state(loc: Column) -> Column:
    """State code: ``, CODE, `` patterns first, then full names in fixed order."""
    rules = [(loc.rlike(f", {code}, "), code) for code in STATE_CODES]
    rules += [(loc.contains(name), code) for name, code in STATE_NAMES]
    return first_match(rules).cast("string")


def parse_country(loc: Column) -> Column:
    return F.when(loc.isNotNull() & (loc != F.lit("")), F.lit(COUNTRY_CODE))

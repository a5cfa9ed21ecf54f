"""Rule table for location parsing: one row per branch plus NULL/blank edges."""

import pytest
from pyspark.sql import functions as F

from hirescope.functions import parse_city, parse_country, parse_state

CASES = [
    # location, city, state, country
    ("Greater Sydney Area", "Sydney", None, "AU"),
    ("Greater Brisbane Area", "Brisbane", None, "AU"),
    ("Perth Area", "Perth", None, "AU"),
    ("Melbourne, VIC, AU", "Melbourne", "VIC", "AU"),
    (" Carlton, VIC, AU", " Carlton", "VIC", "AU"),  # branch 3 does not trim
    ("Parramatta, NSW, AU", "Parramatta", "NSW", "AU"),
    ("Queensland, Australia", None, "QLD", "AU"),
    ("Western Australia, Australia", None, "WA", "AU"),
    ("Australia", None, None, "AU"),
    ("Sydney, New South Wales, Australia", "Sydney", "NSW", "AU"),
    ("Adelaide, South Australia, Australia", "Adelaide", "SA", "AU"),
    ("Nowhere, Western Australia, Australia", "Nowhere", "WA", "AU"),
    (" Hobart , Tasmania", "Hobart", "TAS", "AU"),
    ("Victoria Park, Western Australia", "Victoria Park", "VIC", "AU"),  # Victoria tested before WA
    ("Richmond, VIC", "Richmond", None, "AU"),  # state patterns need a trailing ", "
    ("Darwin, Northern Territory", "Darwin", "NT", "AU"),
    ("Canberra, Australian Capital Territory", "Canberra", "ACT", "AU"),
    ("Remote", None, None, "AU"),
    ("", None, None, None),
    (None, None, None, None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "loc string")
    loc = F.col("loc")
    rows = df.select("loc", parse_city(loc).alias("city"), parse_state(loc).alias("state"),
                     parse_country(loc).alias("country")).collect()
    return {r["loc"]: (r["city"], r["state"], r["country"]) for r in rows}


@pytest.mark.parametrize("loc,city,state,country", CASES)
def test_location_rules(parsed, loc, city, state, country):
    assert parsed[loc] == (city, state, country)

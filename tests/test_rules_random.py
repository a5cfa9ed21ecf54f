"""Random strings through the Spark rules and through the oracle's SQL rules
(DuckDB): both engines must agree on every generated value."""

import duckdb
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hirescope.functions import (
    cloud_platform_focus,
    normalise_employment_type,
    parse_city,
    parse_country,
    parse_state,
    primary_language_hint,
    standardise_seniority,
    tech_skill_category,
)
from hirescope.plans import oracle

LOCATION_TOKENS = [
    "Sydney", "Melbourne", "Greater", "Area", "Brisbane", "Australia", "AU", "VIC", "NSW", "QLD", "SA",
    "WA", "TAS", "NT", "ACT", "Victoria", "New South Wales", "Queensland", "Western Australia",
    "South Australia", "Tasmania", "Northern Territory", "Australian Capital Territory", "Park",
    "Remote", ",", ", ", " ", "",
]
EMPLOYMENT_TOKENS = ["Full", "full", "-", " ", "time", "Time", "part", "Part", "contract", "Contract",
                     "intern", "ship", "temporary", "volunteer", "_", "casual", ""]
SENIORITY_TOKENS = ["mid", "MID", "_", "-", " ", "senior", "SENIOR", "level", "LEVEL", "entry", "Entry",
                    "associate", "Executive", "director", "internship", "Not", "Applicable", ""]
TITLE_TOKENS = ["Data", "data ", "Engineer", "Scientist", "Analyst", "analy", "Software", "Developer", "DevOps",
                "Machine Learning", "ML ", "AI ", "AI", "Thai", "XML ", "Frontend", "Front-End", "Backend",
                "back-end", "Full Stack", "fullstack", "AWS", "Amazon", "Azure", "GCP", "Google Cloud",
                "Python", "Java", "JavaScript", "React", "Node", "C#", ".NET", "C++", "Nurse", " ", ""]


def _texts(tokens):
    return st.one_of(st.none(), st.lists(st.sampled_from(tokens), max_size=6).map("".join))


def _compare(spark, values, spark_exprs, sql_exprs):
    pdf = pd.DataFrame({"v": pd.Series(values, dtype=object)})
    sdf = spark.createDataFrame([(v,) for v in values], "v string")
    got = sdf.select("v", *[e(F.col("v")).alias(n) for n, e in spark_exprs.items()]).toPandas()
    con = duckdb.connect()
    con.register("t", pdf)
    cols = ", ".join(f"{sql} AS {n}" for n, sql in sql_exprs.items())
    want = con.execute(f"SELECT v, {cols} FROM t").fetchdf()
    key = lambda df: sorted(map(repr, df.astype(object).where(df.notna(), None).itertuples(index=False)))
    assert key(got) == key(want)


@settings(max_examples=5, deadline=None)
@given(st.lists(_texts(LOCATION_TOKENS), min_size=50, max_size=80))
def test_location_rules_agree(spark, values):
    _compare(
        spark,
        values,
        {"city": parse_city, "state": parse_state, "country": parse_country},
        {
            "city": oracle.CITY_SQL.replace("job_location", "v"),
            "state": oracle.STATE_SQL.replace("job_location", "v"),
            "country": oracle.COUNTRY_SQL.replace("job_location", "v"),
        },
    )


@settings(max_examples=5, deadline=None)
@given(st.lists(_texts(EMPLOYMENT_TOKENS), min_size=50, max_size=80))
def test_employment_rule_agrees(spark, values):
    _compare(spark, values, {"e": normalise_employment_type},
             {"e": oracle.EMPLOYMENT_SQL.replace("job_employment_type", "v")})


@settings(max_examples=5, deadline=None)
@given(st.lists(_texts(SENIORITY_TOKENS), min_size=50, max_size=80))
def test_seniority_rule_agrees(spark, values):
    sql = oracle.CTE["std_staged"]
    case_sql = sql[sql.index("(") + 1: sql.rindex(" AS job_seniority_level")]
    _compare(spark, values, {"s": standardise_seniority}, {"s": case_sql.replace("job_seniority_level", "v")})


@settings(max_examples=5, deadline=None)
@given(st.lists(_texts(TITLE_TOKENS), min_size=50, max_size=80))
def test_title_rules_agree(spark, values):
    _compare(
        spark,
        values,
        {"c": tech_skill_category, "p": cloud_platform_focus, "l": primary_language_hint},
        {
            "c": oracle.TECH_CATEGORY_SQL.replace("job_title", "v"),
            "p": oracle.CLOUD_SQL.replace("job_title", "v"),
            "l": oracle.LANGUAGE_SQL.replace("job_title", "v"),
        },
    )

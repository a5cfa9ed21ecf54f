"""Title and seniority classification rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import contains_any, first_match

# Fixed values (must equal the reference's for identical results).
SENIORITY_LABELS = [
    (["MID_SENIOR_LEVEL", "MID-SENIOR LEVEL"], "Mid-Senior level"),
    (["ENTRY_LEVEL", "ENTRY LEVEL"], "Entry level"),
    (["SENIOR_LEVEL", "SENIOR LEVEL"], "Senior level"),
    (["ASSOCIATE"], "Associate"),
    (["EXECUTIVE"], "Executive"),
    (["DIRECTOR"], "Director"),
    (["INTERNSHIP"], "Internship"),
]
TECH_CATEGORIES = [
    (["data engineer"], "Data Engineering"),
    (["data scien"], "Data Science"),
    (["data analy"], "Data Analytics"),
    (["software engineer", "developer"], "Software Development"),
    (["devops"], "DevOps"),
    (["machine learning", "ml ", "ai "], "AI/ML"),
    (["frontend", "front-end"], "Frontend Development"),
    (["backend", "back-end"], "Backend Development"),
    (["full stack", "fullstack"], "Full Stack Development"),
]
OTHER_TECH = "Other Tech"
CLOUD_PLATFORMS = [
    (["aws", "amazon"], "AWS"),
    (["azure"], "Azure"),
    (["gcp", "google cloud"], "GCP"),
]
CLOUD_AGNOSTIC = "Cloud Agnostic"
TECH_FUNCTIONS = ["Information Technology", "Engineering", "Engineering and Information Technology"]


def standardise_seniority(col: Column) -> Column:
    up = F.upper(col)
    rules = [(up.isin(spellings), label) for spellings, label in SENIORITY_LABELS]
    return first_match(rules, F.initcap(F.replace(col, F.lit("_"), F.lit(" "))))


def tech_skill_category(title: Column) -> Column:
    t = F.lower(title)
    return first_match([(contains_any(t, n), label) for n, label in TECH_CATEGORIES], OTHER_TECH)


def cloud_platform_focus(title: Column) -> Column:
    t = F.lower(title)
    return first_match([(contains_any(t, n), label) for n, label in CLOUD_PLATFORMS], CLOUD_AGNOSTIC)


def primary_language_hint(title: Column) -> Column:
    t = F.lower(title)
    return first_match(
        [
            (t.contains("python"), "Python"),
            (t.contains("java") & ~t.contains("javascript"), "Java"),
            (contains_any(t, ["javascript", "react", "node"]), "JavaScript"),
            (contains_any(t, ["c#", ".net"]), "C#/.NET"),
            (t.contains("c++"), "C++"),
        ],
        "Not Specified",
    )


def is_tech_function(col: Column) -> Column:
    return col.isin(TECH_FUNCTIONS)

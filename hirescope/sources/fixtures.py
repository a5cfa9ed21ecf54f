"""Job postings and side tables derived from the driver's TPC-H-style tables.

The driver tables hold no job postings, so postings are derived from
``orders JOIN customer`` with expressions that the SQL oracle repeats
verbatim.  Roughly 40 % of rows share the first element of the title,
location, seniority and employment lists ("hot" values) so skew is always
exercised.  Everything scales with ``orders``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The latest o_orderdate at every scale factor; the default "today".
AS_OF = dt.date(2001, 8, 1)

# Fixed values of the fixture (see FIXTURES.md §2).
TITLES = [
    "Senior Data Engineer (AWS)", "Data Scientist - Python", "Data Analyst",
    "Java Developer", "DevOps Engineer Azure", "Machine Learning Lead",
    "Front-End React Dev", "Backend Node Lead", "Full Stack C# Dev", "Thai Chef",
    "JavaScript Developer", "GCP Software Engineer", "Nurse",
]
LOCATIONS = [
    "Sydney, New South Wales, Australia", "Melbourne, VIC, AU", "Greater Brisbane Area",
    "Perth Area", "Queensland, Australia", "Australia", " Hobart , Tasmania",
    "Geelong, Victoria, Australia", "Parramatta, NSW, AU",
    "Adelaide, South Australia, Australia", "Canberra, ACT, AU", "Darwin, NT, AU", "",
    "Nowhere, Western Australia, Australia", "Gold Coast, QLD, AU", None, "Remote",
]
SENIORITIES = [
    "MID_SENIOR_LEVEL", "Mid-Senior level", "ENTRY LEVEL", "associate", "Director",
    "executive", "internship", "Not Applicable", None, "mid_career", "SENIOR_LEVEL",
]
FUNCTIONS = [
    "Information Technology", "Engineering", "Engineering and Information Technology",
    "Sales", None,
]
EMPLOYMENT_TYPES = ["Full-time", "full-time", "Contract", "Part-time", "contract", "  ", None]
WORKPLACE_TYPES = ["REMOTE", "HYBRID", "ONSITE"]
URL_PREFIX = "https://jobs.example/"
#: customers of a town, and orders of a batch of versions
TOWN_CUSTOMERS = 40
BATCH_ORDERS = 1000


def _pick(values: list, index: Column) -> Column:
    """``values[index]`` from a literal array (0-based index, always in range)."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (index + 1).cast("int"))


def _hot(k: Column, index: Column) -> Column:
    return F.when(k % 10 < 4, F.lit(0)).otherwise(index)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def postings(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> DataFrame:
    """One posting per order (14 columns)."""
    orders = _orders(spark, sf_dir)
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    # customer grows with the data: a plain equi-join, AQE broadcasts it only
    # when its measured size is under the broadcast threshold.
    j = orders.join(customers, orders.o_custkey == customers.c_custkey)
    k = F.col("o_orderkey")
    key = k.cast("string")
    posted = F.date_sub(F.lit(str(as_of)).cast("date"), ((k * 11 + 5) % 181).cast("int"))
    return j.select(
        key.alias("job_posting_id"),
        F.concat(F.lit(URL_PREFIX), key).alias("url"),
        _pick(TITLES, _hot(k, (k * 5 + 1) % 13)).alias("job_title"),
        F.concat(F.lit("Company "), F.col("o_custkey").cast("string")).alias("company_name"),
        # towns, of few postings each, grow in number with the data
        F.when(k % 50 == 7, F.concat(F.lit("Town "), F.floor(F.col("o_custkey") / TOWN_CUSTOMERS).cast("string"), F.lit(", QLD, AU")))
        .otherwise(_pick(LOCATIONS, _hot(k, (k * 3 + 2) % 17)))
        .alias("job_location"),
        _pick(SENIORITIES, _hot(k, (k * 7 + 4) % 11)).alias("job_seniority_level"),
        _pick(FUNCTIONS, k % 5).alias("job_function"),
        _pick(EMPLOYMENT_TYPES, _hot(k, (k * 2 + 1) % 7)).alias("job_employment_type"),
        F.when(k % 10 < 3, F.lit("BUILDING")).otherwise(F.col("c_mktsegment")).alias("job_industries"),
        F.when(k % 3 == 0, F.lit(None).cast("double"))
        .when(k % 19 == 0, F.lit(0.0))
        .otherwise(F.floor(F.col("o_totalprice") / 4).cast("double"))
        .alias("min_salary"),
        F.when(k % 4 == 0, F.lit(None).cast("double"))
        .otherwise(F.floor(F.col("o_totalprice") / 3).cast("double"))
        .alias("max_salary"),
        posted.cast("string").alias("job_posted_date"),
        F.col("o_orderdate").alias("scraped_dts"),
        (k % 2).cast("int").alias("job_source"),
    )


def _summary_text() -> Column:
    return F.concat(F.col("job_title"), F.lit(" at "), F.col("company_name"))


def raw_feed_a(posts: DataFrame) -> DataFrame:
    """Feed A rows (job_source 0) in the raw shape: flat salary, date text."""
    return posts.where(F.col("job_source") == 0).select(
        "url", "job_posting_id", "job_title", "company_name", "job_location",
        _summary_text().alias("job_summary"),
        "job_seniority_level", "job_function", "job_employment_type", "job_industries",
        "job_posted_date",
        F.col("min_salary").alias("MIN_AMOUNT"),
        F.col("max_salary").alias("MAX_AMOUNT"),
        F.col("scraped_dts").alias("timestamp"),
        F.lit(None).cast("string").alias("_rescued_data"),
    )


def raw_feed_b(posts: DataFrame) -> DataFrame:
    """Feed B rows (job_source 1): salary struct, ISO posted-date text."""
    return posts.where(F.col("job_source") == 1).select(
        "url", "job_posting_id", "job_title", "company_name", "job_location",
        _summary_text().alias("job_summary"),
        "job_seniority_level", "job_function", "job_employment_type", "job_industries",
        F.concat(F.col("job_posted_date"), F.lit("T00:00:00.000Z")).alias("job_posted_date"),
        F.struct(F.col("min_salary").alias("min_amount"), F.col("max_salary").alias("max_amount")).alias(
            "base_salary"
        ),
        F.col("scraped_dts").alias("timestamp"),
        F.lit(None).cast("string").alias("_rescued_data"),
    )


def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Availability checks for 5 of every 6 postings."""
    k = F.col("o_orderkey")
    return (
        _orders(spark, sf_dir)
        .where(k % 6 != 0)
        .select(
            k.cast("string").alias("job_posting_id"),
            (k % 4 != 0).alias("is_active"),
            (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).cast("timestamp").alias("validated_dts"),
        )
    )


def ai_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-written summaries for 1 of every 3 postings."""
    k = F.col("o_orderkey")
    key = k.cast("string")
    return (
        _orders(spark, sf_dir)
        .where(k % 3 == 1)
        .select(
            key.alias("job_posting_id"),
            F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("Director")).alias(
                "job_seniority_level"
            ),
            _pick(WORKPLACE_TYPES, k % 7 % 3).alias("workplace_type"),
            F.floor(F.col("o_totalprice") / 5).cast("double").alias("min_salary"),
            F.floor(F.col("o_totalprice") / 2).cast("double").alias("max_salary"),
            F.lit("data").alias("it_domains"),
            F.concat(F.lit("summary "), key).alias("ai_summaries"),
            (F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")).cast("timestamp").alias("summarized_dts"),
        )
    )


def upsert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned change rows: one id a customer, one version an order."""
    k = F.col("o_orderkey")
    return _orders(spark, sf_dir).select(
        F.col("o_custkey").cast("string").alias("id"),
        k.alias("version"),
        F.floor(k / BATCH_ORDERS).cast("int").alias("batch_no"),
        F.col("o_totalprice").alias("amount"),
    )

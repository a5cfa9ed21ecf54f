"""Registered queries: ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL)``.

Every query derives its input from the driver tables (orders, customer), so
its work grows with them.  The SQL oracle for each key is in ``oracle.py``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import (
    cloud_platform_focus,
    normalise_employment_type,
    parse_city,
    parse_country,
    parse_state,
    primary_language_hint,
    standardise_seniority,
    tech_skill_category,
)
from ..operators import (
    clean_feed,
    clean_feed_legacy,
    descriptions,
    enrich,
    geocode,
    latest_per_key,
    load_availability,
    marts,
    since,
    unify,
    upsert,
)
from ..session import work_path
from ..sources import fixtures
from ..sources.files import bronze_stamp, read_availability_csv, read_raw_feed
from ..sources import sinks
from ..sources.sinks import merge_into_table, write_partitioned
from ..streaming import ingest_files, ingest_latest
from . import jobs, pipeline
from . import oracle as _o
from .oracle import with_ctes

AS_OF = fixtures.AS_OF
# two-load scenarios: postings scraped before SPLIT_FIRST arrive on FIRST_LOAD
FIRST_LOAD = dt.date(2001, 7, 31)
SPLIT_FIRST = "1999-01-01 00:00:00"
SPLIT_SECOND = "1998-01-01 00:00:00"
LEGACY_MARK = "1997-06-01 00:00:00"
QueryFn = Callable[[SparkSession, str], DataFrame]

SPARK: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def _posts(spark, sf):
    return fixtures.postings(spark, sf, AS_OF)


def _cleaned_both(spark, sf):
    ca, cb = pipeline.cleaned_feeds(spark, sf, AS_OF)
    return cb.unionByName(ca)


def _staged(spark, sf):
    return pipeline.staged_postings(spark, sf, AS_OF)


# ------------------------------------------------------------------ cleaning


register("city_parse", with_ctes(f"SELECT job_posting_id, job_location, {_o.CITY_SQL} AS job_city FROM postings", "postings"))(
    lambda spark, sf: _posts(spark, sf).select(
        "job_posting_id", "job_location", parse_city(F.col("job_location")).alias("job_city")
    )
)

register("state_parse", with_ctes(f"SELECT job_posting_id, job_location, {_o.STATE_SQL} AS job_state FROM postings", "postings"))(
    lambda spark, sf: _posts(spark, sf).select(
        "job_posting_id", "job_location", parse_state(F.col("job_location")).alias("job_state")
    )
)

register(
    "country_parse",
    with_ctes(f"SELECT job_posting_id, job_location, {_o.COUNTRY_SQL} AS job_country FROM postings", "postings"),
)(
    lambda spark, sf: _posts(spark, sf).select(
        "job_posting_id", "job_location", parse_country(F.col("job_location")).alias("job_country")
    )
)


@register(
    "employment_type",
    with_ctes(
        f"SELECT job_posting_id, job_employment_type AS raw_employment_type, {_o.EMPLOYMENT_SQL} AS job_employment_type FROM bronze_a",
        "bronze_a",
    ),
)
def q_employment_type(spark, sf):
    a, _ = pipeline.bronze_feeds(spark, sf, AS_OF)
    return a.select(
        "job_posting_id",
        F.col("job_employment_type").alias("raw_employment_type"),
        normalise_employment_type(F.col("job_employment_type")).alias("job_employment_type"),
    )


@register(
    "employment_type_fixed",
    with_ctes(
        f"SELECT job_posting_id, job_employment_type AS raw_employment_type, {_o.EMPLOYMENT_FIXED_SQL} AS job_employment_type "
        "FROM bronze_a",
        "bronze_a",
    ),
)
def q_employment_type_fixed(spark, sf):
    """The opt-in fix: lower-case first, so 'Full-time' maps to FULL_TIME."""
    a, _ = pipeline.bronze_feeds(spark, sf, AS_OF)
    return a.select(
        "job_posting_id",
        F.col("job_employment_type").alias("raw_employment_type"),
        normalise_employment_type(F.col("job_employment_type"), mode="fixed").alias("job_employment_type"),
    )


_BOTH = "SELECT {cols} FROM cleaned_b UNION ALL SELECT {cols} FROM cleaned_a"


def _both_sql(cols: str) -> str:
    return with_ctes(_BOTH.format(cols=cols), "cleaned_a", "cleaned_b")


register("posted_date", _both_sql("job_posting_id, job_source, job_posted_date"))(
    lambda spark, sf: _cleaned_both(spark, sf).select("job_posting_id", "job_source", "job_posted_date")
)
register("salary_bounds", _both_sql("job_posting_id, job_source, min_salary, max_salary"))(
    lambda spark, sf: _cleaned_both(spark, sf).select("job_posting_id", "job_source", "min_salary", "max_salary")
)
register("tag_source", _both_sql("job_posting_id, is_enriched, job_source, is_active, year, month, day"))(
    lambda spark, sf: _cleaned_both(spark, sf).select(
        "job_posting_id", "is_enriched", "job_source", "is_active", "year", "month", "day"
    )
)
register("clean_feed_a", with_ctes("SELECT * FROM cleaned_a", "cleaned_a"))(
    lambda spark, sf: pipeline.cleaned_feeds(spark, sf, AS_OF)[0]
)
register("clean_feed_b", with_ctes("SELECT * FROM cleaned_b", "cleaned_b"))(
    lambda spark, sf: pipeline.cleaned_feeds(spark, sf, AS_OF)[1]
)


@register(
    "clean_legacy",
    with_ctes(
        f"""SELECT url, job_posting_id, job_title, company_name, job_location, job_summary, job_seniority_level,
  job_function, job_employment_type, job_industries, MIN_AMOUNT AS min_salary, MAX_AMOUNT AS max_salary,
  {_o.POSTED_A_SQL} AS job_posted_date, "timestamp" AS scraped_dts, ingest_dts, _rescued_data,
  0 AS is_enriched, 0 AS job_source, 1 AS is_active, {_o.PARTS_SQL}
FROM bronze_a""",
        "bronze_a",
    ),
)
def q_clean_legacy(spark, sf):
    a, _ = pipeline.bronze_feeds(spark, sf, AS_OF)
    return clean_feed_legacy(a, "a", AS_OF)


@register(
    "clean_legacy_incremental",
    with_ctes(
        f"""SELECT url, job_posting_id, job_title, company_name, job_location, job_summary, job_seniority_level,
  job_function, job_employment_type, job_industries, MIN_AMOUNT AS min_salary, MAX_AMOUNT AS max_salary,
  {_o.POSTED_A_SQL} AS job_posted_date, "timestamp" AS scraped_dts, ingest_dts, _rescued_data,
  0 AS is_enriched, 0 AS job_source, 1 AS is_active, {_o.PARTS_SQL}
FROM bronze_a WHERE "timestamp" > TIMESTAMP '{LEGACY_MARK}'""",
        "bronze_a",
    ),
)
def q_clean_legacy_incremental(spark, sf):
    """The older tree's filter: raw event time against the target's ingest time."""
    a, _ = pipeline.bronze_feeds(spark, sf, AS_OF)
    loaded = a.withColumn("ingest_dts", F.lit(LEGACY_MARK).cast("timestamp"))
    target = clean_feed_legacy(loaded.where(F.col("timestamp") < F.lit(LEGACY_MARK).cast("timestamp_ntz")), "a", AS_OF)
    return clean_feed_legacy(a, "a", AS_OF, target=target)


def _legacy_sql(src: str, min_s: str, max_s: str, posted: str, source: int) -> str:
    return f"""SELECT url, job_posting_id, job_title, company_name, job_location, job_seniority_level,
  job_function, job_employment_type, job_industries, {min_s} AS min_salary, {max_s} AS max_salary,
  {posted} AS job_posted_date, "timestamp" AS scraped_dts, ingest_dts, _rescued_data,
  0 AS is_enriched, {source} AS job_source, 1 AS is_active
FROM {src}"""


@register(
    "unify_legacy",
    with_ctes(
        _legacy_sql("bronze_b", "base_salary.min_amount", "base_salary.max_amount", _o.POSTED_B_SQL, 1)
        + "\nUNION ALL\n"
        + _legacy_sql("bronze_a", "MIN_AMOUNT", "MAX_AMOUNT", _o.POSTED_A_SQL, 0),
        "bronze_a",
        "bronze_b",
    ),
)
def q_unify_legacy(spark, sf):
    """Older model tree: both feeds cleaned without location parsing, integer
    flags, then unioned with the raw location kept."""
    a, b = pipeline.bronze_feeds(spark, sf, AS_OF)
    return unify(clean_feed_legacy(b, "b", AS_OF), clean_feed_legacy(a, "a", AS_OF),
                 columns=schemas.LEGACY_UNIFIED_COLUMNS)


# ------------------------------------------------------------ unify / enrich

register("unify", with_ctes("SELECT * FROM unified", "unified"))(
    lambda spark, sf: pipeline.silver(spark, sf, AS_OF).unified
)


@register("descriptions", _both_sql("job_posting_id, job_summary, scraped_dts"))
def q_descriptions(spark, sf):
    ca, cb = pipeline.cleaned_feeds(spark, sf, AS_OF)
    return descriptions(cb, ca)


@register(
    "descriptions_incremental",
    with_ctes(
        f"""SELECT job_posting_id, job_summary, scraped_dts FROM cleaned_b
UNION ALL
SELECT job_posting_id, job_summary, scraped_dts FROM cleaned_a
WHERE scraped_dts > (SELECT COALESCE(max(scraped_dts), TIMESTAMP '1900-01-01 00:00:00') FROM (
  SELECT scraped_dts FROM cleaned_b WHERE scraped_dts < TIMESTAMP '{SPLIT_FIRST}'
  UNION ALL SELECT scraped_dts FROM cleaned_a WHERE scraped_dts < TIMESTAMP '{SPLIT_FIRST}'))""",
        "cleaned_a",
        "cleaned_b",
    ),
)
def q_descriptions_incremental(spark, sf):
    """Incremental descriptions against a target holding postings scraped
    before 1999: the scrape-time filter binds to the feed A branch only, so
    every feed B description is re-merged."""
    ca, cb = pipeline.cleaned_feeds(spark, sf, AS_OF)
    cut = F.lit(SPLIT_FIRST).cast("timestamp_ntz")
    target = descriptions(cb.where(F.col("scraped_dts") < cut), ca.where(F.col("scraped_dts") < cut))
    return descriptions(cb, ca, target=target)


register("load_availability", with_ctes("SELECT * FROM availability", "availability"))(
    lambda spark, sf: pipeline.silver(spark, sf, AS_OF).availability
)
register("load_ai_summaries", with_ctes("SELECT * FROM ai_summaries", "ai_summaries"))(
    lambda spark, sf: pipeline.silver(spark, sf, AS_OF).summaries
)
register("enrich_seniority", with_ctes("SELECT job_posting_id, job_source, job_seniority_level FROM enriched", "enriched"))(
    lambda spark, sf: pipeline.silver(spark, sf, AS_OF).enriched.select(
        "job_posting_id", "job_source", "job_seniority_level"
    )
)
register("enrich_salary", with_ctes("SELECT job_posting_id, min_salary, max_salary FROM enriched", "enriched"))(
    lambda spark, sf: pipeline.silver(spark, sf, AS_OF).enriched.select("job_posting_id", "min_salary", "max_salary")
)
register("enrich_active", with_ctes("SELECT job_posting_id, is_active FROM enriched", "enriched"))(
    lambda spark, sf: pipeline.silver(spark, sf, AS_OF).enriched.select("job_posting_id", "is_active")
)
register("enrich", with_ctes("SELECT * FROM enriched", "enriched"))(
    lambda spark, sf: pipeline.silver(spark, sf, AS_OF).enriched
)
register("stage_active", with_ctes("SELECT * FROM staged", "staged"))(_staged)

# ------------------------------------------------------------ classification

register(
    "seniority_standard",
    with_ctes(
        "SELECT s.job_posting_id, s.job_seniority_level AS raw_seniority_level, t.job_seniority_level "
        "FROM staged s JOIN std_staged t USING (job_posting_id)",
        "staged",
        "std_staged",
    ),
)(
    lambda spark, sf: _staged(spark, sf).select(
        "job_posting_id",
        F.col("job_seniority_level").alias("raw_seniority_level"),
        standardise_seniority(F.col("job_seniority_level")).alias("job_seniority_level"),
    )
)
register("tech_category", with_ctes(f"SELECT job_posting_id, job_title, {_o.TECH_CATEGORY_SQL} AS tech_skill_category FROM staged", "staged"))(
    lambda spark, sf: _staged(spark, sf).select(
        "job_posting_id", "job_title", tech_skill_category(F.col("job_title")).alias("tech_skill_category")
    )
)
register("cloud_focus", with_ctes(f"SELECT job_posting_id, job_title, {_o.CLOUD_SQL} AS cloud_platform_focus FROM staged", "staged"))(
    lambda spark, sf: _staged(spark, sf).select(
        "job_posting_id", "job_title", cloud_platform_focus(F.col("job_title")).alias("cloud_platform_focus")
    )
)
register("language_hint", with_ctes(f"SELECT job_posting_id, job_title, {_o.LANGUAGE_SQL} AS primary_language_hint FROM staged", "staged"))(
    lambda spark, sf: _staged(spark, sf).select(
        "job_posting_id", "job_title", primary_language_hint(F.col("job_title")).alias("primary_language_hint")
    )
)
register("tech_roles", with_ctes(
    "SELECT job_posting_id, job_function, tech_skill_category, cloud_platform_focus, primary_language_hint FROM tech_roles",
    "tech_roles"))(
    lambda spark, sf: marts.classify_tech_roles(_staged(spark, sf)).select(
        "job_posting_id", "job_function", "tech_skill_category", "cloud_platform_focus", "primary_language_hint"
    )
)

# ----------------------------------------------------------------- geography

register("geocode", with_ctes("SELECT * FROM geo_data", "geo_data"))(lambda spark, sf: geocode(_staged(spark, sf)))
register("distance_sydney", with_ctes("SELECT job_posting_id, distance_from_sydney_km FROM geo_data", "geo_data"))(
    lambda spark, sf: geocode(_staged(spark, sf)).select("job_posting_id", "distance_from_sydney_km")
)
register("mid_salary", with_ctes("SELECT job_posting_id, mid_salary FROM geo_data", "geo_data"))(
    lambda spark, sf: geocode(_staged(spark, sf)).select("job_posting_id", "mid_salary")
)
register("geo_aggregate", with_ctes("SELECT * FROM geo_aggregate", "geo_aggregate"))(
    lambda spark, sf: marts.geo_aggregate(_staged(spark, sf), AS_OF)
)
register("geo_mart", with_ctes("SELECT * FROM geo_mart ORDER BY opportunity_index DESC", "geo_mart"))(
    lambda spark, sf: marts.geo_mart(_staged(spark, sf), AS_OF)
)

# ---------------------------------------------------------------------- marts

register("job_density", with_ctes("SELECT * FROM density_v1", "density_v1"))(
    lambda spark, sf: marts.job_density(_staged(spark, sf), AS_OF)
)
register("heatmap_v1", with_ctes("SELECT * FROM heatmap_v1", "heatmap_v1"))(
    lambda spark, sf: marts.heatmap(_staged(spark, sf), AS_OF)
)
register("heatmap_v2", with_ctes("SELECT * FROM heatmap_v2", "heatmap_v2"))(
    lambda spark, sf: marts.heatmap(_staged(spark, sf), AS_OF, standardise=True)
)
register("company_metrics", with_ctes("SELECT * FROM company_metrics", "company_metrics"))(
    lambda spark, sf: marts.company_metrics(_staged(spark, sf), AS_OF)
)
register("company_mart", with_ctes("SELECT * FROM company_mart", "company_mart"))(
    lambda spark, sf: marts.company_mart(_staged(spark, sf), AS_OF)
)
register("skills_demand", with_ctes(
    "SELECT * REPLACE (CAST(demand_momentum_ratio AS DOUBLE) AS demand_momentum_ratio) FROM skills_demand",
    "skills_demand"))(
    lambda spark, sf: marts.skills_demand(_staged(spark, sf), AS_OF).withColumn(
        "demand_momentum_ratio", F.col("demand_momentum_ratio").cast("double")
    )
)
register("skills_mart", with_ctes("SELECT * FROM skills_mart ORDER BY opportunity_score DESC", "skills_mart"))(
    lambda spark, sf: marts.skills_mart(_staged(spark, sf), AS_OF)
)

# ------------------------------------------- each score and band on its own key

_HEAT_KEYS = marts.HEATMAP_KEYS
_COMPANY_KEYS = ["company_name", "job_industries"]
_SKILL_KEYS = marts.SKILL_KEYS
_GEO_KEYS = marts.GEO_KEYS

SCORE_KEYS = {
    # key: (mart CTE / builder, group columns, score column)
    "market_temperature": ("heatmap_v1", _HEAT_KEYS, "market_temperature"),
    "competitiveness_score": ("heatmap_v1", _HEAT_KEYS, "competitiveness_score"),
    "heatmap_opportunity_index": ("heatmap_v1", _HEAT_KEYS, "opportunity_index"),
    "hiring_velocity_score": ("company_mart", _COMPANY_KEYS, "hiring_velocity_score"),
    "hiring_stage": ("company_mart", _COMPANY_KEYS, "hiring_stage"),
    "hiring_strategy": ("company_mart", _COMPANY_KEYS, "hiring_strategy"),
    "complexity_score": ("company_mart", _COMPANY_KEYS, "complexity_score"),
    "market_presence": ("company_mart", _COMPANY_KEYS, "market_presence"),
    "demand_momentum_ratio": ("skills_mart", _SKILL_KEYS, "demand_momentum_ratio"),
    "demand_level": ("skills_mart", _SKILL_KEYS, "demand_level"),
    "market_trend": ("skills_mart", _SKILL_KEYS, "market_trend"),
    "skills_opportunity_score": ("skills_mart", _SKILL_KEYS, "opportunity_score"),
    "market_size": ("geo_mart", _GEO_KEYS, "market_size"),
    "activity_level": ("geo_mart", _GEO_KEYS, "activity_level"),
    "salary_tier": ("geo_mart", _GEO_KEYS, "salary_tier"),
    "market_diversity_score": ("geo_mart", _GEO_KEYS, "market_diversity_score"),
    "flexibility_ratio": ("geo_mart", _GEO_KEYS, "flexibility_ratio"),
    "geo_opportunity_index": ("geo_mart", _GEO_KEYS, "opportunity_index"),
}

_MART_BUILDERS = {
    "heatmap_v1": lambda staged: marts.heatmap(staged, AS_OF),
    "company_mart": lambda staged: marts.company_mart(staged, AS_OF),
    "skills_mart": lambda staged: marts.skills_mart(staged, AS_OF, sort=False),
    "geo_mart": lambda staged: marts.geo_mart(staged, AS_OF, sort=False),
}


def _score_query(mart: str, keys: list[str], column: str) -> QueryFn:
    def run(spark, sf):
        return _MART_BUILDERS[mart](_staged(spark, sf)).select(*keys, column)

    return run


for _name, (_mart, _keys, _col) in SCORE_KEYS.items():
    register(_name, with_ctes(f"SELECT {', '.join(_keys)}, {_col} FROM {_mart}", _mart))(
        _score_query(_mart, list(_keys), _col)
    )


# ---------------------------------------------------------------- incremental

WM_CUTOFF = "2000-01-01 00:00:00"


@register(
    "since_watermark",
    with_ctes(
        f"""SELECT job_posting_id, "timestamp" FROM bronze_a
WHERE "timestamp" > (SELECT COALESCE(max("timestamp"), TIMESTAMP '1900-01-01 00:00:00')
                     FROM bronze_a WHERE "timestamp" < TIMESTAMP '{WM_CUTOFF}')""",
        "bronze_a",
    ),
)
def q_since_watermark(spark, sf):
    a, _ = pipeline.bronze_feeds(spark, sf, AS_OF)
    target = a.where(F.col("timestamp") < F.lit(WM_CUTOFF).cast("timestamp_ntz"))
    return since(a, target, "timestamp").select("job_posting_id", "timestamp")


_BATCHES_SQL = f"""SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderkey AS version,
  CAST(o_orderkey // {fixtures.BATCH_ORDERS} AS INTEGER) AS batch_no, o_totalprice AS amount FROM orders"""

_LATEST_SQL = f"""SELECT id, version, batch_no, amount FROM ({_BATCHES_SQL}) b
QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1"""

register("latest_per_key", _LATEST_SQL)(
    lambda spark, sf: latest_per_key(fixtures.upsert_batches(spark, sf), ["id"], ["version"])
)


@register("upsert", _LATEST_SQL)
def q_upsert(spark, sf):
    """Load batches 0-1 as the target, then merge every later batch in one upsert;
    the result must equal keeping the latest version of every id."""
    rows = fixtures.upsert_batches(spark, sf)
    target = latest_per_key(rows.where(F.col("batch_no") < 2), ["id"], ["version"])
    return upsert(target, rows.where(F.col("batch_no") >= 2), ["id"], order=["version"])


# ------------------------------------------------------------ sinks and streams

_CLEANED_BOTH_SQL = "SELECT * FROM cleaned_b UNION ALL SELECT * FROM cleaned_a"


@register("partitioned_rebuild", with_ctes(_CLEANED_BOTH_SQL, "cleaned_a", "cleaned_b"))
def q_partitioned_rebuild(spark, sf):
    """Write both cleaned feeds as a load-date partitioned table and read it back."""
    path = work_path(spark, "cleaned")
    write_partitioned(_cleaned_both(spark, sf), path)
    return spark.read.parquet(path).select(*schemas.CLEANED_COLUMNS)




def _cleaned_loaded(spark, sf, load_date):
    posts = fixtures.postings(spark, sf, AS_OF)
    a = bronze_stamp(fixtures.raw_feed_a(posts), load_date, with_file_path=False)
    b = bronze_stamp(fixtures.raw_feed_b(posts), load_date, with_file_path=False)
    return clean_feed(b, "b", load_date).unionByName(clean_feed(a, "a", load_date))


_MERGE_SQL = with_ctes(
    f"""SELECT * REPLACE (
  CASE WHEN scraped_dts < TIMESTAMP '{SPLIT_SECOND}' THEN TIMESTAMP '{FIRST_LOAD} 00:00:00' ELSE ingest_dts END AS ingest_dts,
  CASE WHEN scraped_dts < TIMESTAMP '{SPLIT_SECOND}' THEN {FIRST_LOAD.month} ELSE month END AS month,
  CASE WHEN scraped_dts < TIMESTAMP '{SPLIT_SECOND}' THEN {FIRST_LOAD.day} ELSE day END AS day)
FROM ({_CLEANED_BOTH_SQL}) c""",
    "cleaned_a",
    "cleaned_b",
)


@register("merge_partitioned", _MERGE_SQL)
def q_merge_partitioned(spark, sf):
    """Two loads into one partitioned table: postings scraped before 1999 on
    the first load date, then those from 1998 on, on the next.  The 1998
    postings move to the newer partition; the rest stay."""
    path = work_path(spark, "merged")
    first = _cleaned_loaded(spark, sf, FIRST_LOAD)
    merge_into_table(spark, path, first.where(F.col("scraped_dts") < F.lit(SPLIT_FIRST).cast("timestamp_ntz")),
                     ["job_posting_id"])
    second = _cleaned_loaded(spark, sf, AS_OF)
    merge_into_table(spark, path, second.where(F.col("scraped_dts") >= F.lit(SPLIT_SECOND).cast("timestamp_ntz")),
                     ["job_posting_id"], order=["ingest_dts"])
    return spark.read.parquet(path).select(*schemas.CLEANED_COLUMNS)


@register(
    "load_availability_csv",
    with_ctes(
        """SELECT * REPLACE (CASE WHEN CAST(job_posting_id AS BIGINT) % 7 = 0 THEN NULL ELSE CAST(is_active AS VARCHAR) END AS is_active) FROM availability""",
        "availability",
    ),
)
def q_load_availability_csv(spark, sf):
    """Availability pool through the CSV source with an explicit schema; the
    flag comes as 1/0, as true/false and, for some rows, as an odd word."""
    path = work_path(spark, "availability-csv")
    k, active = F.col("job_posting_id").cast("long"), F.col("is_active")
    flag = F.when(k % 7 == 0, "maybe").when(k % 2 == 0, F.when(active, "1").otherwise("0")).otherwise(active.cast("string"))
    fixtures.availability(spark, sf).withColumn("is_active", flag).write.option("header", True).csv(path)
    loaded = load_availability(read_availability_csv(spark, path), AS_OF)
    return loaded.withColumn("is_active", F.col("is_active").cast("string"))


def _merge_catalog(spark, buckets=0, **named):
    """A catalog table of its own, and the folder its versions are in."""
    database, root = f"hs_{uuid.uuid4().hex[:10]}", work_path(spark, "catalog")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    return sinks.CatalogTable(f"{database}.cleaned", buckets, **named), f"{root}/cleaned"


_LOAD_PARTS = ["year", "month", "day"]


@register("merge_resume", _MERGE_SQL)
def q_merge_resume(spark, sf):
    """The two loads of merge_partitioned into a catalog table.  The second
    one is staged and never published (a driver lost before the commit), then
    merged again in two halves."""
    table, path = _merge_catalog(spark)
    first = _cleaned_loaded(spark, sf, FIRST_LOAD)
    key = ["job_posting_id"]
    merge_into_table(spark, path, first.where(F.col("scraped_dts") < F.lit(SPLIT_FIRST).cast("timestamp_ntz")), key, table=table)
    second = _cleaned_loaded(spark, sf, AS_OF).where(F.col("scraped_dts") >= F.lit(SPLIT_SECOND).cast("timestamp_ntz"))
    half = F.pmod(F.xxhash64("job_posting_id"), F.lit(2))
    for part in (0, 1):
        sinks.stage_merge(spark, path, second.where(half == part), key, _LOAD_PARTS, True, None, table)  # never published
        merge_into_table(spark, path, second.where(half == part), key, order=["ingest_dts"], table=table)
    return table.read(spark).select(*schemas.CLEANED_COLUMNS)


@register("merge_interleaved", _MERGE_SQL)
def q_merge_interleaved(spark, sf):
    """The two loads into a catalog table that is read at every step of the
    second: readers that were planned before, between and after see a whole
    version each; the rows returned are those of the reader after, less those
    that an earlier reader should have seen and did not (none)."""
    table, path = _merge_catalog(spark)
    key, stamp = ["job_posting_id"], lambda text: F.lit(text).cast("timestamp_ntz")
    first = _cleaned_loaded(spark, sf, FIRST_LOAD).where(F.col("scraped_dts") < stamp(SPLIT_FIRST))
    second = _cleaned_loaded(spark, sf, AS_OF).where(F.col("scraped_dts") >= stamp(SPLIT_SECOND))
    merge_into_table(spark, path, first, key, table=table)
    before = table.read(spark)
    publish = sinks.stage_merge(spark, path, second, key, _LOAD_PARTS, True, None, table)
    between = table.read(spark)
    publish()
    after = table.read(spark)
    # every reader of the first version finds exactly the first load, before and after the commit
    expected = first.select(F.col("job_posting_id").alias("id"))
    odd = [(seen.select(F.col("job_posting_id").alias("id"))) for seen in (before, between)]
    missing = reduce(DataFrame.unionByName, [expected.exceptAll(ids).unionByName(ids.exceptAll(expected)) for ids in odd])
    return after.join(missing, after["job_posting_id"] == missing["id"], "left_anti").select(*schemas.CLEANED_COLUMNS)


STREAM_FILES = 4


@register("stream_ingest", with_ctes("SELECT * FROM cleaned_a", "cleaned_a"))
def q_stream_ingest(spark, sf):
    """Feed A lands as several Parquet files; a streaming query ingests them
    one file per micro-batch and merges each into the cleaned table."""
    landing = work_path(spark, "landing-a")
    posts = fixtures.postings(spark, sf, AS_OF)
    fixtures.raw_feed_a(posts).repartition(STREAM_FILES, "job_posting_id").write.parquet(landing)
    target = work_path(spark, "stream-target")
    ingest_files(spark, landing, "a", target, work_path(spark, "stream-ckpt"), AS_OF, max_files_per_trigger=1)
    return spark.read.parquet(target).select(*schemas.CLEANED_COLUMNS)


@register("stream_drop_late", with_ctes(f"SELECT * FROM cleaned_a WHERE scraped_dts >= TIMESTAMP '{SPLIT_SECOND}'", "cleaned_a"))
def q_stream_drop_late(spark, sf):
    """Recent postings land first; a later file of older ones is dropped by
    the reference's event-time mark."""
    landing, target, checkpoint = (work_path(spark, n) for n in ("landing-late", "late-target", "late-ckpt"))
    raw = fixtures.raw_feed_a(fixtures.postings(spark, sf, AS_OF))
    cut = F.lit(SPLIT_SECOND).cast("timestamp_ntz")
    raw.where(F.col("timestamp") >= cut).write.parquet(landing)
    ingest_files(spark, landing, "a", target, checkpoint, AS_OF, drop_late=True)
    raw.where(F.col("timestamp") < cut).write.mode("append").parquet(landing)
    ingest_files(spark, landing, "a", target, checkpoint, AS_OF, drop_late=True)
    return sinks.read_table(spark, target).select(*schemas.CLEANED_COLUMNS)


@register("stream_keep_latest", with_ctes("SELECT * FROM cleaned_a", "cleaned_a"))
def q_stream_keep_latest(spark, sf):
    """Feed A lands, then a file with a third of it delivered again and
    another third a day older: a stream that knows each posting's newest row
    passes none of them on, and the older ones are kept aside."""
    landing, target, late, checkpoint = (work_path(spark, n) for n in ("landing-latest", "latest-target", "latest-late", "latest-ckpt"))
    raw = fixtures.raw_feed_a(fixtures.postings(spark, sf, AS_OF))
    third = F.col("job_posting_id").cast("long") % 3
    raw.write.parquet(landing)
    ingest_latest(spark, landing, "a", target, checkpoint, AS_OF, late)
    older = raw.where(third == 1).withColumns({"timestamp": F.col("timestamp") - F.expr("INTERVAL 1 DAY"), "job_title": F.lit("older")})
    raw.where(third == 0).unionByName(older).write.mode("append").parquet(landing)
    ingest_latest(spark, landing, "a", target, checkpoint, AS_OF, late)
    aside = spark.read.parquet(late).select("job_posting_id")
    kept = sinks.read_table(spark, target)
    # a posting whose older row was not kept aside would be missing here
    safe = kept.where(F.col("job_posting_id").cast("long") % 3 != 1).select("job_posting_id").unionByName(aside)
    return kept.join(safe, "job_posting_id", "left_semi").select(*schemas.CLEANED_COLUMNS)


# ------------------------------------------------- incremental tiers (two loads)


def _bronze_loaded(spark, sf, feed, load_date):
    posts = fixtures.postings(spark, sf, AS_OF)
    raw = fixtures.raw_feed_a(posts) if feed == "a" else fixtures.raw_feed_b(posts)
    return bronze_stamp(raw, load_date, with_file_path=False)


def _two_loads(df_for_load):
    """Rows scraped before 1999 arrive on the first load date, the rest on the next."""
    cut = F.lit(SPLIT_FIRST).cast("timestamp_ntz")
    old = df_for_load(FIRST_LOAD)
    new = df_for_load(AS_OF)
    return old.where(F.col("scraped_dts" if "scraped_dts" in old.columns else "timestamp") < cut), new.where(
        F.col("scraped_dts" if "scraped_dts" in new.columns else "timestamp") >= cut
    )


@register(
    "incremental_clean",
    with_ctes(f"""SELECT * FROM cleaned_a WHERE scraped_dts >= TIMESTAMP '{SPLIT_FIRST}'""", "cleaned_a"),
)
def q_incremental_clean(spark, sf):
    """Bronze holds two loads; the cleaned target already has the first, so an
    incremental run keeps only rows ingested after the target's latest."""
    old_b, new_b = _two_loads(lambda d: _bronze_loaded(spark, sf, "a", d))
    target = clean_feed(old_b, "a", FIRST_LOAD)
    return clean_feed(old_b.unionByName(new_b), "a", AS_OF, target=target)


@register(
    "incremental_enrich",
    with_ctes(f"""SELECT * FROM enriched WHERE scraped_dts >= TIMESTAMP '{SPLIT_FIRST}'""", "enriched"),
)
def q_incremental_enrich(spark, sf):
    """Unified postings from two loads; the enriched target holds the first
    load, enriched then.  Only postings ingested after that enrichment time
    are enriched now (ingest time compared with enrichment time)."""
    silver = pipeline.silver(spark, sf, AS_OF)
    old_u, new_u = _two_loads(lambda d: _cleaned_loaded(spark, sf, d).select(*schemas.UNIFIED_COLUMNS))
    target = enrich(old_u, silver.availability, silver.summaries, FIRST_LOAD)
    return enrich(old_u.unionByName(new_u), silver.availability, silver.summaries, AS_OF, target=target)


LINEAGE_SLICES = 4


@register(
    "bronze_lineage",
    with_ctes(
        f"""SELECT job_posting_id, "timestamp", ingest_dts,
  'slice' || CAST(CAST(job_posting_id AS BIGINT) % {LINEAGE_SLICES} AS VARCHAR) AS source_folder, {_o.PARTS_SQL} FROM bronze_a""",
        "bronze_a",
    ),
)
def q_bronze_lineage(spark, sf):
    """Raw feed A files, landed in one folder per id class, read back with
    their fixed schema and stamped with load time, load-date parts and each
    row's source file, whose folder tells the id class."""
    landing = work_path(spark, "raw-a")
    raw = fixtures.raw_feed_a(fixtures.postings(spark, sf, AS_OF))
    folders = [f"{landing}/slice{i}" for i in range(LINEAGE_SLICES)]
    for i, folder in enumerate(folders):
        raw.where(F.col("job_posting_id").cast("long") % LINEAGE_SLICES == i).write.parquet(folder)
    bronze = bronze_stamp(read_raw_feed(spark, folders, "a"), AS_OF)
    return bronze.select(
        "job_posting_id", "timestamp", "ingest_dts",
        F.regexp_extract("source_file", "/(slice[0-9]+)/[^/]+$", 1).alias("source_folder"), "year", "month", "day",
    )


@register(
    "bronze_rescued",
    with_ctes(
        """SELECT job_posting_id, CASE WHEN CAST(job_posting_id AS BIGINT) % 5 = 0 THEN NULL ELSE MIN_AMOUNT END AS MIN_AMOUNT,
  CASE WHEN CAST(job_posting_id AS BIGINT) % 5 = 0 AND MIN_AMOUNT IS NOT NULL THEN 'about ' || CAST(CAST(MIN_AMOUNT AS BIGINT) AS VARCHAR) END AS rescued_amount,
  CASE WHEN CAST(job_posting_id AS BIGINT) % 3 = 0 THEN company_name END AS rescued_recruiter
FROM bronze_a""",
        "bronze_a",
    ),
)
def q_bronze_rescued(spark, sf):
    """Feed A files that drifted: the salary is text that does not always
    convert, and an unknown column turns up.  Both are kept as rescued data."""
    landing = work_path(spark, "raw-drifted")
    k, amount = F.col("job_posting_id").cast("long"), F.col("MIN_AMOUNT")
    text = F.when(k % 5 == 0, F.concat(F.lit("about "), amount.cast("long").cast("string"))).otherwise(amount.cast("string"))
    raw = fixtures.raw_feed_a(fixtures.postings(spark, sf, AS_OF)).drop("_rescued_data")
    raw.withColumns({"MIN_AMOUNT": text, "recruiter": F.when(k % 3 == 0, F.col("company_name"))}).write.parquet(landing)
    kept = F.from_json("_rescued_data", "map<string,string>")
    return read_raw_feed(spark, landing, "a").select(
        "job_posting_id", "MIN_AMOUNT", kept["MIN_AMOUNT"].alias("rescued_amount"), kept["recruiter"].alias("rescued_recruiter")
    )


@register(
    "bronze_drifted",
    with_ctes(
        """SELECT job_posting_id, CASE WHEN CAST(job_posting_id AS BIGINT) % 10 = 4 THEN NULL ELSE MIN_AMOUNT END AS MIN_AMOUNT,
  CASE WHEN CAST(job_posting_id AS BIGINT) % 10 = 4 AND MIN_AMOUNT IS NOT NULL THEN 'from ' || CAST(CAST(MIN_AMOUNT AS BIGINT) AS VARCHAR) END AS rescued_amount,
  CASE WHEN CAST(job_posting_id AS BIGINT) % 5 = 1 THEN CAST(CAST(job_posting_id AS BIGINT) % 7 AS VARCHAR) END AS rescued_rank,
  'drift' || CAST(CAST(job_posting_id AS BIGINT) % 5 AS VARCHAR) AS source_folder
FROM bronze_a""",
        "bronze_a",
    ),
)
def q_bronze_drifted(spark, sf):
    """Feed A from producers that contradict each other: the salary is a
    double in some files, a whole number, a decimal or (odd) text in others,
    and an unknown column is a number.  All files load; what does not fit is
    kept as rescued data."""
    landing = work_path(spark, "raw-contradicting")
    k, amount = F.col("job_posting_id").cast("long"), F.col("MIN_AMOUNT")
    raw = fixtures.raw_feed_a(fixtures.postings(spark, sf, AS_OF)).drop("_rescued_data")
    odd = F.when(k % 10 == 4, F.concat(F.lit("from "), amount.cast("long").cast("string"))).otherwise(amount.cast("string"))
    shapes = [{}, {"rank": k % 7}, {"MIN_AMOUNT": amount.cast("long")}, {"MIN_AMOUNT": amount.cast("decimal(12,2)")}, {"MIN_AMOUNT": odd}]
    for i, shape in enumerate(shapes):
        raw.where(k % 5 == i).withColumns(shape).write.parquet(f"{landing}/drift{i}")
    kept = F.from_json("_rescued_data", "map<string,string>")
    return read_raw_feed(spark, [f"{landing}/drift{i}" for i in range(len(shapes))], "a").select(
        "job_posting_id", "MIN_AMOUNT", kept["MIN_AMOUNT"].alias("rescued_amount"), kept["rank"].alias("rescued_rank"),
        F.regexp_extract("source_file", "/(drift[0-9]+)/[^/]+$", 1).alias("source_folder"),
    )


# ------------------------------------------------- the tier-by-tier job on files


def _land(spark, sf, root, scraped_filter=None, side_tables=True):
    """Write the four raw inputs (derived from the driver tables) as files."""
    posts = fixtures.postings(spark, sf, AS_OF)
    if scraped_filter is not None:
        posts = posts.where(scraped_filter)
    fixtures.raw_feed_a(posts).write.mode("append").parquet(f"{root}/feed_a")
    fixtures.raw_feed_b(posts).write.mode("append").parquet(f"{root}/feed_b")
    if side_tables:
        fixtures.availability(spark, sf).write.mode("append").option("header", True).csv(f"{root}/availability")
        fixtures.ai_summaries(spark, sf).write.mode("append").parquet(f"{root}/ai_summaries")
    return jobs.RawInputs(f"{root}/feed_a", f"{root}/feed_b", f"{root}/availability", f"{root}/ai_summaries")


@register("pipeline_run", with_ctes("SELECT * FROM heatmap_v2", "heatmap_v2"))
def q_pipeline_run(spark, sf):
    """Raw files -> every bronze, silver and gold table; the v2 heatmap read back."""
    raw = _land(spark, sf, work_path(spark, "landing"))
    layout = jobs.Layout(work_path(spark, "warehouse"))
    written = jobs.run(spark, raw, layout, AS_OF)
    return spark.read.parquet(written["heatmap_v2"])


#: model -> (rows' name, one text that depends on the model's rules)
MODEL_DIGESTS = {
    "bronze_a": ("job_posting_id", "job_location"),
    "bronze_b": ("job_posting_id", "job_location"),
    "cleaned_a": ("job_posting_id", "concat_ws('|', job_city, job_state, job_country, job_employment_type, job_posted_date)"),
    "cleaned_b": ("job_posting_id", "concat_ws('|', job_city, job_state, job_country, job_employment_type, job_posted_date)"),
    "unified": ("job_posting_id", "concat_ws('|', job_city, job_state, company_name, job_posted_date)"),
    "descriptions": ("job_posting_id", "job_summary"),
    "availability": ("job_posting_id", "CASE WHEN is_active THEN 'active' ELSE 'gone' END"),
    "ai_summaries": ("job_posting_id", "concat_ws('|', job_seniority_level, workplace_type, it_domains, ai_summaries)"),
    "enriched": ("job_posting_id", "concat_ws('|', job_seniority_level, workplace_type, ai_summaries, CASE WHEN is_active THEN 'active' ELSE 'gone' END)"),
    "staged": ("job_posting_id", "concat_ws('|', job_url, job_seniority_level, job_city)"),
    "heatmap": (f"concat_ws('|', {', '.join(marts.HEATMAP_KEYS)})", "market_temperature"),
    "heatmap_v2": (f"concat_ws('|', {', '.join(marts.HEATMAP_KEYS)})", "market_temperature"),
    "company_hiring": ("concat_ws('|', company_name, job_industries)", "concat_ws('|', hiring_stage, hiring_strategy, market_presence)"),
    "skills_demand": (f"concat_ws('|', {', '.join(marts.SKILL_KEYS)})", "concat_ws('|', demand_level, market_trend)"),
    "geography": ("concat_ws('|', state, city)", "concat_ws('|', city_tier, market_size, activity_level, salary_tier)"),
}
_MODEL_SOURCES = {"heatmap": "heatmap_v1", "company_hiring": "company_mart", "skills_demand": "skills_mart", "geography": "geo_mart"}
_MODEL_SQL = {m: _MODEL_SOURCES.get(m, m) if m != "descriptions" else f"({_CLEANED_BOTH_SQL})" for m in MODEL_DIGESTS}


@register(
    "pipeline_models",
    with_ctes(
        " UNION ALL ".join(f"SELECT '{m}' AS model, {k} AS row_name, {v} AS content FROM {_MODEL_SQL[m]} AS m" for m, (k, v) in MODEL_DIGESTS.items()),
        *(s for m, s in _MODEL_SQL.items() if m != "descriptions"),
    ),
)
def q_pipeline_models(spark, sf):
    """Every table that one run of the job writes: its rows' names and a text
    that depends on the model's rules."""
    raw = _land(spark, sf, work_path(spark, "landing"))
    written = jobs.run(spark, raw, jobs.Layout(work_path(spark, "warehouse")), AS_OF)
    assert set(written) == set(MODEL_DIGESTS)
    tables = [
        sinks.read_table(spark, written[m]).select(F.lit(m).alias("model"), F.expr(k).alias("row_name"), F.expr(v).alias("content"))
        for m, (k, v) in MODEL_DIGESTS.items()
    ]
    return reduce(DataFrame.unionByName, tables)


@register("pipeline_same_day", with_ctes("SELECT * EXCLUDE (ingest_dts, enriched_dts, dbt_created_at, dbt_updated_at) FROM staged", "staged"))
def q_pipeline_same_day(spark, sf):
    """Two loads on one day, each with its own load time: the second one's
    postings reach staging like the first one's."""
    root = work_path(spark, "landing")
    layout = jobs.Layout(work_path(spark, "warehouse"))
    cut = F.lit(SPLIT_FIRST).cast("timestamp_ntz")
    raw = _land(spark, sf, root, F.col("scraped_dts") < cut)
    morning = dt.datetime.combine(AS_OF, dt.time(8))
    jobs.run(spark, raw, layout, AS_OF, marts=False, load_ts=morning)
    _land(spark, sf, root, F.col("scraped_dts") >= cut, side_tables=False)
    written = jobs.run(spark, raw, layout, AS_OF, marts=False, load_ts=morning + dt.timedelta(hours=8))
    return sinks.read_table(spark, written["staged"]).select(*schemas.STAGED_COLUMNS).drop("ingest_dts", "enriched_dts", "dbt_created_at", "dbt_updated_at")


@register("pipeline_orc", with_ctes("SELECT * FROM staged", "staged"))
def q_pipeline_orc(spark, sf):
    """The whole job with ORC tables; staging read back."""
    raw = _land(spark, sf, work_path(spark, "landing"))
    written = jobs.run(spark, raw, jobs.Layout(work_path(spark, "warehouse"), format="orc"), AS_OF, marts=False)
    return sinks.read_table(spark, written["staged"], "orc").select(*schemas.STAGED_COLUMNS)


@register("pipeline_views", with_ctes("SELECT * FROM heatmap_v2", "heatmap_v2"))
def q_pipeline_views(spark, sf):
    """The same job with every model materialised as a temp view: nothing is
    written between models and the mart is read back by name."""
    raw = _land(spark, sf, work_path(spark, "landing"))
    layout = jobs.Layout(materialize="view", view_prefix=f"hs_{uuid.uuid4().hex[:8]}_")
    written = jobs.run(spark, raw, layout, AS_OF)
    return spark.table(written["heatmap_v2"])


_TWO_LOAD_STAGED_SQL = with_ctes(
    f"""SELECT * REPLACE (
  CASE WHEN scraped_dts < TIMESTAMP '{SPLIT_FIRST}' THEN TIMESTAMP '{FIRST_LOAD} 00:00:00' ELSE ingest_dts END AS ingest_dts,
  CASE WHEN scraped_dts < TIMESTAMP '{SPLIT_FIRST}' THEN TIMESTAMP '{FIRST_LOAD} 00:00:00' ELSE enriched_dts END AS enriched_dts,
  CASE WHEN scraped_dts < TIMESTAMP '{SPLIT_FIRST}' THEN TIMESTAMP '{FIRST_LOAD} 00:00:00' ELSE dbt_created_at END AS dbt_created_at,
  CASE WHEN scraped_dts < TIMESTAMP '{SPLIT_FIRST}' THEN TIMESTAMP '{FIRST_LOAD} 00:00:00' ELSE dbt_updated_at END AS dbt_updated_at)
FROM staged""",
    "staged",
)


@register("pipeline_incremental", _TWO_LOAD_STAGED_SQL)
def q_pipeline_incremental(spark, sf):
    """Two runs of the job: postings scraped before 1999 land first, the rest
    land later; the second run only processes what is new at every tier."""
    root = work_path(spark, "landing")
    layout = jobs.Layout(work_path(spark, "warehouse"))
    cut = F.lit(SPLIT_FIRST).cast("timestamp_ntz")
    raw = _land(spark, sf, root, F.col("scraped_dts") < cut)
    jobs.run(spark, raw, layout, FIRST_LOAD, marts=False)
    _land(spark, sf, root, F.col("scraped_dts") >= cut, side_tables=False)
    written = jobs.run(spark, raw, layout, AS_OF, marts=False)
    return spark.read.parquet(written["staged"]).select(*schemas.STAGED_COLUMNS)


@register("pipeline_stream", _TWO_LOAD_STAGED_SQL)
def q_pipeline_stream(spark, sf):
    """The two-load job with bronze kept by a file stream: each run reads
    only the raw files that arrived since the previous one."""
    root = work_path(spark, "landing")
    layout = jobs.Layout(work_path(spark, "warehouse"))
    cut = F.lit(SPLIT_FIRST).cast("timestamp_ntz")
    raw = _land(spark, sf, root, F.col("scraped_dts") < cut)
    jobs.run(spark, raw, layout, FIRST_LOAD, marts=False, bronze_mode="stream")
    _land(spark, sf, root, F.col("scraped_dts") >= cut, side_tables=False)
    written = jobs.run(spark, raw, layout, AS_OF, marts=False, bronze_mode="stream")
    return spark.read.parquet(written["staged"]).select(*schemas.STAGED_COLUMNS)


BUCKETS = 8


@register("pipeline_bucketed", _TWO_LOAD_STAGED_SQL)
def q_pipeline_bucketed(spark, sf):
    """The two-load job with catalog tables; unified, availability and
    summaries are bucketed by posting id so the enrichment joins them
    without a shuffle."""
    root = work_path(spark, "landing")
    layout = jobs.Layout(work_path(spark, "warehouse"), catalog=f"hs_{uuid.uuid4().hex[:10]}", buckets=BUCKETS)
    cut = F.lit(SPLIT_FIRST).cast("timestamp_ntz")
    raw = _land(spark, sf, root, F.col("scraped_dts") < cut)
    jobs.run(spark, raw, layout, FIRST_LOAD, marts=False)
    _land(spark, sf, root, F.col("scraped_dts") >= cut, side_tables=False)
    jobs.run(spark, raw, layout, AS_OF, marts=False)
    return spark.table(layout.table_name("staged")).select(*schemas.STAGED_COLUMNS)


def _two_load_marts(spark, sf, mart):
    """The two-load job with catalog tables whose marts are kept from partials:
    the second run reads the partitions of staging that are new, and the
    partials of the others."""
    root = work_path(spark, "landing")
    layout = jobs.Layout(work_path(spark, "warehouse"), catalog=f"hs_{uuid.uuid4().hex[:10]}")
    stamp = lambda text: F.lit(text).cast("timestamp_ntz")
    raw = _land(spark, sf, root, F.col("scraped_dts") < stamp(SPLIT_FIRST))
    jobs.run(spark, raw, layout, FIRST_LOAD, incremental_marts=True)
    _land(spark, sf, root, F.col("scraped_dts") >= stamp(SPLIT_FIRST), side_tables=False)
    written = jobs.run(spark, raw, layout, AS_OF, incremental_marts=True)
    return sinks.read_table(spark, written[mart])


register("heatmap_incremental", with_ctes("SELECT * FROM heatmap_v2", "heatmap_v2"))(lambda spark, sf: _two_load_marts(spark, sf, "heatmap_v2"))
register("company_incremental", with_ctes("SELECT * FROM company_mart", "company_mart"))(lambda spark, sf: _two_load_marts(spark, sf, "company_hiring"))


def queries() -> dict[str, QueryFn]:
    return dict(SPARK)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

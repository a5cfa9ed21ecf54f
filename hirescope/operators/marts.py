"""Gold marts: heatmap (v1/v2), company hiring intelligence, skills demand,
geography.  Each mart is one grouped aggregate plus per-group scores.

Group-level scores are computed on the (small) aggregated output; the only
shuffles are the aggregate's own (map-side partial aggregation first) and,
for marts that are sorted, one range exchange over the aggregated rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    as_date,
    cloud_platform_focus,
    is_tech_function,
    posted_on_or_after,
    primary_language_hint,
    standardise_seniority,
    tech_skill_category,
)
from ..functions.classify import OTHER_TECH
from ..sources.files import as_of_timestamp
from .geo import geocode
from .incremental import key_match


def _dec(text: str) -> Column:
    """A decimal literal, as SQL's ``10.0`` is."""
    return F.lit(Decimal(text))


def _recent(as_of, days: int) -> Column:
    return posted_on_or_after(as_date(F.col("job_posted_date")), as_of, days)


def _count_if(pred: Column) -> Column:
    return F.count(F.when(pred, F.lit(1)))


def _sum_if(pred: Column) -> Column:
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0)))


# ---------------------------------------------------------------- heatmap

HEATMAP_KEYS = ["job_city", "job_state", "job_industries", "job_seniority_level", "job_employment_type"]


def job_density(staged: DataFrame, as_of, standardise: bool = False) -> DataFrame:
    """Group by city, state, industry, seniority, employment type (city not NULL)."""
    df = staged
    if standardise:
        df = df.withColumn("job_seniority_level", standardise_seniority(F.col("job_seniority_level")))
    return (
        df.where(F.col("job_city").isNotNull())
        .groupBy(*HEATMAP_KEYS)
        .agg(
            F.count(F.lit(1)).alias("job_count"),
            F.countDistinct("company_name").alias("unique_companies"),
            F.avg("min_salary").alias("avg_min_salary"),
            F.avg("max_salary").alias("avg_max_salary"),
            _count_if(_recent(as_of, 7)).alias("jobs_last_7_days"),
            _count_if(_recent(as_of, 30)).alias("jobs_last_30_days"),
        )
    )


def market_temperature(jobs_7d: Column, jobs_30d: Column) -> Column:
    return (
        F.when(jobs_7d >= 5, "HOT").when(jobs_7d >= 2, "WARM").when(jobs_30d >= 5, "MODERATE").otherwise("COOL")
    )


def competitiveness_score(job_count: Column, companies: Column, jobs_7d: Column) -> Column:
    raw = job_count * _dec("10.0") / F.nullif(companies, F.lit(0)) + jobs_7d * 5
    return F.least(F.lit(100), F.round(raw, 0)).cast("double")


def heatmap_opportunity_index(job_count: Column, companies: Column, avg_max: Column) -> Column:
    salary = F.when(avg_max > 0, F.ln(avg_max / 50000 + 1)).otherwise(F.lit(1.0))
    return F.round(F.ln(job_count + 1) * F.ln(companies + 1) * salary, 2)


def heatmap(staged: DataFrame, as_of, standardise: bool = False) -> DataFrame:
    """Job-market heatmap; ``standardise=True`` is v2 (canonical seniority)."""
    return _heatmap_scores(job_density(staged, as_of, standardise))


def heatmap_partials(staged: DataFrame, by: list[str], standardise: bool = False) -> DataFrame:
    """What ``heatmap_from_partials`` needs of some rows, whatever the day it
    looks back from: sums for each group, company and posting day, which add
    up over any split of the rows."""
    df = staged.where(F.col("job_city").isNotNull()).withColumn("_posted", as_date(F.col("job_posted_date")))
    if standardise:
        df = df.withColumn("job_seniority_level", standardise_seniority(F.col("job_seniority_level")))
    return df.groupBy(*by, *HEATMAP_KEYS, "company_name", "_posted").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("min_salary").alias("_low"), F.count("min_salary").alias("_n_low"),
        F.sum("max_salary").alias("_high"), F.count("max_salary").alias("_n_high"),
    )


def heatmap_from_partials(partials: DataFrame, as_of) -> DataFrame:
    """The heatmap from partials of all its rows."""
    recent = lambda days: F.sum(F.when(posted_on_or_after(F.col("_posted"), as_of, days), F.col("_n")).otherwise(F.lit(0)))
    return _heatmap_scores(
        partials.groupBy(*HEATMAP_KEYS).agg(
            F.sum("_n").alias("job_count"),
            F.countDistinct("company_name").alias("unique_companies"),
            F.try_divide(F.sum("_low"), F.sum("_n_low")).alias("avg_min_salary"),
            F.try_divide(F.sum("_high"), F.sum("_n_high")).alias("avg_max_salary"),
            recent(7).alias("jobs_last_7_days"),
            recent(30).alias("jobs_last_30_days"),
        )
    )


def _heatmap_scores(density: DataFrame) -> DataFrame:
    c = F.col
    return density.withColumns(
        {
            "market_temperature": market_temperature(c("jobs_last_7_days"), c("jobs_last_30_days")),
            "competitiveness_score": competitiveness_score(
                c("job_count"), c("unique_companies"), c("jobs_last_7_days")
            ),
            "opportunity_index": heatmap_opportunity_index(
                c("job_count"), c("unique_companies"), c("avg_max_salary")
            ),
        }
    )


# ------------------------------------------------------ company intelligence

# Fixed values (must equal the reference's): seniority labels counted as
# junior, mid-senior and leadership roles.  Band thresholds are written
# inline in each band function below.
JUNIOR = ["Entry level", "Associate"]
MID_SENIOR = "Mid-Senior level"
LEADERSHIP = ["Director", "Executive"]


def _company_counts() -> dict[str, Column]:
    emp, sen = F.col("job_employment_type"), F.col("job_seniority_level")
    return {
        "fulltime_roles": _sum_if(emp == "Full-time"),
        "contract_roles": _sum_if(emp == "Contract"),
        "parttime_roles": _sum_if(emp == "Part-time"),
        "junior_roles": _sum_if(sen.isin(JUNIOR)),
        "midsenior_roles": _sum_if(sen == MID_SENIOR),
        "leadership_roles": _sum_if(sen.isin(LEADERSHIP)),
    }


COMPANY_KEYS = ["company_name", "job_industries"]
COMPANY_WINDOWS = {"jobs_last_7d": 7, "jobs_last_30d": 30, "jobs_last_90d": 90}
# three exact distinct counts make four rows for each posting, so the postings are dealt to many tasks first (as many
# as a shuffle still writes without sorting)
COMPANY_TASKS = 200


def company_metrics(staged: DataFrame, as_of) -> DataFrame:
    """Group by company and industry: volume, windows, employment, seniority,
    salary.  Distinct counts are exact; no set of raw values is collected.

    First and latest date are text, and one text among the aggregates makes
    Spark sort all four rows of each posting instead of hashing them: the two
    are taken beside, from the same exchange, and joined to the groups."""
    low = F.when(F.col("min_salary") > 0, F.col("min_salary"))
    high = F.when(F.col("max_salary") > 0, F.col("max_salary"))
    used = [*COMPANY_KEYS, "job_title", "job_function", "job_city", "job_employment_type", "job_seniority_level",
            "job_posted_date", "min_salary", "max_salary"]
    # by all of them: a company of any size is spread
    dealt = staged.select(*used).repartition(COMPANY_TASKS, *used)
    dates = dealt.groupBy(*COMPANY_KEYS).agg(F.min("job_posted_date").alias("first_posting_date"), F.max("job_posted_date").alias("latest_posting_date"))
    counts = dealt.groupBy(*COMPANY_KEYS).agg(
        F.count(F.lit(1)).alias("total_job_postings"),
        F.countDistinct("job_title").alias("unique_roles"),
        F.countDistinct("job_function").alias("function_diversity"),
        F.countDistinct("job_city").alias("geographic_spread"),
        *(_count_if(_recent(as_of, days)).alias(name) for name, days in COMPANY_WINDOWS.items()),
        *(c.alias(name) for name, c in _company_counts().items()),
        F.avg(low).alias("avg_min_salary"),
        F.avg(high).alias("avg_max_salary"),
    )
    return counts.alias("t").join(dates.alias("b"), key_match(COMPANY_KEYS)).select("t.*", "first_posting_date", "latest_posting_date")


def company_partials(staged: DataFrame, by: list[str]) -> DataFrame:
    """What ``company_from_partials`` needs of some rows, whatever the day it
    looks back from: sums for each company, industry, title, function, city
    and posting day, which add up over any split of the rows."""
    low = F.when(F.col("min_salary") > 0, F.col("min_salary"))
    high = F.when(F.col("max_salary") > 0, F.col("max_salary"))
    return staged.withColumn("_posted", as_date(F.col("job_posted_date"))).groupBy(*by, *COMPANY_KEYS, "job_title", "job_function", "job_city", "_posted").agg(
        F.count(F.lit(1)).alias("_n"),
        *(c.alias(name) for name, c in _company_counts().items()),
        F.sum(low).alias("_low"), F.count(low).alias("_n_low"), F.sum(high).alias("_high"), F.count(high).alias("_n_high"),
        F.min("job_posted_date").alias("_first"), F.max("job_posted_date").alias("_latest"),
    )


def company_from_partials(partials: DataFrame, as_of) -> DataFrame:
    """The company mart from partials of all its rows."""
    recent = lambda days: F.sum(F.when(posted_on_or_after(F.col("_posted"), as_of, days), F.col("_n")).otherwise(F.lit(0)))
    metrics = partials.groupBy(*COMPANY_KEYS).agg(
        F.sum("_n").alias("total_job_postings"),
        F.countDistinct("job_title").alias("unique_roles"),
        F.countDistinct("job_function").alias("function_diversity"),
        F.countDistinct("job_city").alias("geographic_spread"),
        *(recent(days).alias(name) for name, days in COMPANY_WINDOWS.items()),
        *(F.sum(name).alias(name) for name in _company_counts()),
        F.try_divide(F.sum("_low"), F.sum("_n_low")).alias("avg_min_salary"),
        F.try_divide(F.sum("_high"), F.sum("_n_high")).alias("avg_max_salary"),
        F.min("_first").alias("first_posting_date"),
        F.max("_latest").alias("latest_posting_date"),
    )
    return _company_scores(metrics)


def hiring_velocity_score(jobs_30d: Column, jobs_90d: Column) -> Column:
    return F.round(jobs_30d * _dec("12.0") / F.greatest(jobs_90d, F.lit(1)), 1).cast("double")


def hiring_stage(jobs_7d: Column, jobs_30d: Column, jobs_90d: Column) -> Column:
    return (
        F.when(jobs_7d >= 10, "RAPID_EXPANSION")
        .when(jobs_30d >= 15, "HIGH_GROWTH")
        .when(jobs_30d >= 5, "STEADY_GROWTH")
        .when(jobs_90d >= 5, "MODERATE_HIRING")
        .otherwise("LIMITED_HIRING")
    )


def hiring_strategy(contract: Column, fulltime: Column, leadership: Column, junior: Column, mid: Column) -> Column:
    return (
        F.when(contract > fulltime, "CONTRACT_FOCUSED")
        .when(leadership > junior + mid, "LEADERSHIP_HEAVY")
        .when(junior > mid + leadership, "TALENT_DEVELOPMENT")
        .otherwise("BALANCED_HIRING")
    )


def complexity_score(roles: Column, cities: Column, functions: Column) -> Column:
    return F.round(F.sqrt(roles) * F.sqrt(cities) * F.ln(functions + 1), 1)


def market_presence(total: Column) -> Column:
    return (
        F.when(total >= 20, "MAJOR_PLAYER")
        .when(total >= 10, "ACTIVE_HIRER")
        .when(total >= 5, "REGULAR_HIRER")
        .otherwise("SELECTIVE_HIRER")
    )


def company_mart(staged: DataFrame, as_of) -> DataFrame:
    return _company_scores(company_metrics(staged, as_of))


def _company_scores(metrics: DataFrame) -> DataFrame:
    c = F.col
    return metrics.withColumns(
        {
            "hiring_velocity_score": hiring_velocity_score(c("jobs_last_30d"), c("jobs_last_90d")),
            "hiring_stage": hiring_stage(c("jobs_last_7d"), c("jobs_last_30d"), c("jobs_last_90d")),
            "hiring_strategy": hiring_strategy(
                c("contract_roles"), c("fulltime_roles"), c("leadership_roles"), c("junior_roles"),
                c("midsenior_roles"),
            ),
            "complexity_score": complexity_score(c("unique_roles"), c("geographic_spread"), c("function_diversity")),
            "market_presence": market_presence(c("total_job_postings")),
        }
    )


# ------------------------------------------------------------ skills demand

SKILL_KEYS = ["tech_skill_category", "cloud_platform_focus", "primary_language_hint", "job_seniority_level", "job_state"]


def classify_tech_roles(staged: DataFrame) -> DataFrame:
    """Tech-function postings with category, cloud and language hints."""
    title = F.col("job_title")
    return staged.where(is_tech_function(F.col("job_function"))).withColumns(
        {
            "tech_skill_category": tech_skill_category(title),
            "cloud_platform_focus": cloud_platform_focus(title),
            "primary_language_hint": primary_language_hint(title),
        }
    )


def demand_momentum_ratio(jobs_30d: Column, jobs_120d: Column) -> Column:
    return F.round(jobs_30d * _dec("4.0") / F.nullif(jobs_120d, F.lit(0)), 2)


def skills_demand(staged: DataFrame, as_of) -> DataFrame:
    """Demand per category, cloud, language, seniority and state (no 'Other Tech')."""
    r30, r120 = _recent(as_of, 30), _recent(as_of, 120)
    return (
        classify_tech_roles(staged)
        .where(F.col("tech_skill_category") != OTHER_TECH)
        .groupBy(*SKILL_KEYS)
        .agg(
            F.count(F.lit(1)).alias("total_demand"),
            _count_if(r30).alias("recent_demand"),
            F.countDistinct("company_name").alias("companies_hiring"),
            F.avg(F.when(F.col("max_salary") > 0, F.col("max_salary"))).alias("avg_max_salary"),
            _count_if(F.col("job_employment_type") == "Contract").alias("contract_demand"),
            _count_if(_recent(as_of, 7)).alias("weekly_postings"),
            demand_momentum_ratio(_count_if(r30), _count_if(r120)).alias("demand_momentum_ratio"),
        )
    )


def demand_level(recent: Column) -> Column:
    return (
        F.when(recent >= 10, "HIGH_DEMAND")
        .when(recent >= 5, "MODERATE_DEMAND")
        .when(recent >= 2, "LOW_DEMAND")
        .otherwise("MINIMAL_DEMAND")
    )


def market_trend(momentum: Column) -> Column:
    """NULL momentum (no 120-day history) falls through to DECLINING."""
    return (
        F.when(momentum >= _dec("1.5"), "RAPIDLY_GROWING")
        .when(momentum >= _dec("1.2"), "GROWING")
        .when(momentum >= _dec("0.8"), "STABLE")
        .otherwise("DECLINING")
    )


def skills_opportunity_score(recent: Column, companies: Column, avg_max: Column, momentum: Column) -> Column:
    """``least(100, ...)``: a NULL term makes the sum NULL and least() skips
    NULL, so such a group scores 100 (reference behaviour)."""
    salary = F.when(avg_max > 100000, F.lit(20)).otherwise(avg_max / 5000)
    raw = recent * 5 + companies * 3 + salary + momentum * 10
    return F.least(F.lit(100), F.round(raw, 0)).cast("double")


def skills_mart(staged: DataFrame, as_of, sort: bool = True) -> DataFrame:
    c = F.col
    out = skills_demand(staged, as_of).withColumns(
        {
            "demand_level": demand_level(c("recent_demand")),
            "market_trend": market_trend(c("demand_momentum_ratio")),
            "opportunity_score": skills_opportunity_score(
                c("recent_demand"), c("companies_hiring"), c("avg_max_salary"), c("demand_momentum_ratio")
            ),
        }
    ).withColumn("demand_momentum_ratio", c("demand_momentum_ratio").cast("double"))
    # ties in the order of the group's columns
    return out.orderBy(F.desc("opportunity_score"), *SKILL_KEYS) if sort else out


# ---------------------------------------------------------------- geography

GEO_KEYS = ["state", "city", "latitude", "longitude", "city_tier"]


def geo_aggregate(staged: DataFrame, as_of) -> DataFrame:
    """Group geocoded postings by state, city, point and tier; 19 measures.
    The two arrays (wanted in the output) are as large as their distinct
    values."""
    g = geocode(staged).withColumnsRenamed({"job_state": "state", "job_city": "city"})
    emp, sen, mid = F.col("job_employment_type"), F.col("job_seniority_level"), F.col("mid_salary")
    positive_mid = F.when(mid > 0, mid)
    agg = g.groupBy(*GEO_KEYS).agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.countDistinct("company_name").alias("unique_companies"),
        F.sort_array(F.collect_set("job_function")).alias("top_functions"),
        F.sort_array(F.collect_set("job_industries")).alias("top_industries"),
        _sum_if(emp == "Full-time").alias("fulltime_jobs"),
        _sum_if(emp == "Contract").alias("contract_jobs"),
        _sum_if(emp == "Part-time").alias("parttime_jobs"),
        _sum_if(sen.isin(JUNIOR)).alias("entry_level_jobs"),
        _sum_if(sen == MID_SENIOR).alias("midsenior_jobs"),
        _sum_if(sen.isin(LEADERSHIP)).alias("senior_jobs"),
        F.count(positive_mid).alias("salary_sample_size"),
        F.avg(positive_mid).alias("avg_salary"),
        F.min(positive_mid).alias("min_salary_market"),
        F.max(positive_mid).alias("max_salary_market"),
        _count_if(_recent(as_of, 7)).alias("jobs_last_week"),
        _count_if(_recent(as_of, 30)).alias("jobs_last_month"),
        F.avg("distance_from_sydney_km").alias("avg_distance_from_sydney"),
    )
    return agg.withColumns(
        {
            "function_diversity": F.size("top_functions").cast("long"),
            "industry_diversity": F.size("top_industries").cast("long"),
        }
    )


def market_size(total: Column) -> Column:
    return (
        F.when(total >= 50, "MAJOR_MARKET")
        .when(total >= 20, "SIGNIFICANT_MARKET")
        .when(total >= 10, "EMERGING_MARKET")
        .when(total >= 5, "SMALL_MARKET")
        .otherwise("MINIMAL_MARKET")
    )


def activity_level(week: Column, month: Column) -> Column:
    return (
        F.when(week >= 5, "VERY_ACTIVE").when(month >= 10, "ACTIVE").when(month >= 3, "MODERATE").otherwise("QUIET")
    )


def salary_tier(avg_salary: Column) -> Column:
    return (
        F.when(avg_salary >= 120000, "HIGH_SALARY")
        .when(avg_salary >= 90000, "COMPETITIVE_SALARY")
        .when(avg_salary >= 70000, "AVERAGE_SALARY")
        .when(avg_salary > 0, "BELOW_AVERAGE_SALARY")
        .otherwise("SALARY_UNKNOWN")
    )


def market_diversity_score(functions: Column, industries: Column, companies: Column, tier: Column) -> Column:
    bonus = F.when(tier == "Major", F.lit(20)).when(tier == "Secondary", F.lit(10)).otherwise(F.lit(5))
    return F.least(F.lit(100), F.round(functions * 10 + industries * 8 + companies * 3 + bonus, 0)).cast("long")


def flexibility_ratio(contract: Column, parttime: Column, total: Column) -> Column:
    return F.round((contract + parttime) * _dec("100.0") / total, 1).cast("double")


def geo_opportunity_index(total: Column, companies: Column, avg_salary: Column, month: Column) -> Column:
    salary = F.when(avg_salary > 50000, F.ln(avg_salary / 50000 + 1)).otherwise(F.lit(1.0))
    activity = (F.lit(1) + month / _dec("10.0")).cast("double")
    return F.round(F.ln(total + 1) * F.ln(companies + 1) * salary * activity, 2)


GEO_MART_COLUMNS = [
    "state", "city", "latitude", "longitude", "city_tier", "total_jobs", "unique_companies",
    "function_diversity", "industry_diversity", "market_size", "activity_level", "fulltime_jobs",
    "contract_jobs", "parttime_jobs", "flexibility_ratio", "entry_level_jobs", "midsenior_jobs",
    "senior_jobs", "avg_salary", "min_salary_market", "max_salary_market", "salary_sample_size",
    "salary_tier", "jobs_last_week", "jobs_last_month", "market_diversity_score", "opportunity_index",
    "avg_distance_from_sydney", "top_industries", "top_functions", "analysis_date",
]


def geo_mart(staged: DataFrame, as_of, sort: bool = True) -> DataFrame:
    c = F.col
    out = geo_aggregate(staged, as_of).withColumns(
        {
            "market_size": market_size(c("total_jobs")),
            "activity_level": activity_level(c("jobs_last_week"), c("jobs_last_month")),
            "salary_tier": salary_tier(c("avg_salary")),
            "market_diversity_score": market_diversity_score(
                c("function_diversity"), c("industry_diversity"), c("unique_companies"), c("city_tier")
            ),
            "flexibility_ratio": flexibility_ratio(c("contract_jobs"), c("parttime_jobs"), c("total_jobs")),
            "opportunity_index": geo_opportunity_index(
                c("total_jobs"), c("unique_companies"), c("avg_salary"), c("jobs_last_month")
            ),
            "analysis_date": as_of_timestamp(as_of),
        }
    ).select(*GEO_MART_COLUMNS)
    return out.orderBy(F.desc("opportunity_index"), "state", "city") if sort else out

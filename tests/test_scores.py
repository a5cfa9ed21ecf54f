"""Band and score rules at every edge (4/5, 9/10, 14/15, 19/20, 49/50 ...)."""

import datetime as dt

from pyspark.sql import functions as F

from hirescope.operators import marts

AS_OF = dt.date(2001, 8, 1)


def _eval(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_market_temperature(spark):
    rows = [(5, 5), (4, 9), (2, 2), (1, 5), (1, 4), (0, 0)]
    got = _eval(spark, rows, "d7 long, d30 long", marts.market_temperature(F.col("d7"), F.col("d30")))
    assert got == ["HOT", "WARM", "WARM", "MODERATE", "COOL", "COOL"]


def test_competitiveness_and_opportunity(spark):
    rows = [(3, 2, 1), (20, 1, 20), (4, 0, 0)]
    got = _eval(spark, rows, "j long, c long, d7 long",
                marts.competitiveness_score(F.col("j"), F.col("c"), F.col("d7")))
    # 3*10/2 + 5 = 20 ; capped at 100 ; zero companies -> NULL term, least() skips it
    assert got == [20.0, 100.0, 100.0]
    got = _eval(spark, [(1, 1, 50000.0), (1, 1, None)], "j long, c long, s double",
                marts.heatmap_opportunity_index(F.col("j"), F.col("c"), F.col("s")))
    assert got == [round(0.6931471805599453 ** 2 * 0.6931471805599453, 2), round(0.6931471805599453 ** 2, 2)]


def test_company_bands(spark):
    stage = _eval(spark, [(10, 0, 0), (9, 15, 0), (0, 14, 0), (0, 5, 0), (0, 4, 5), (0, 4, 4)],
                  "a long, b long, c long", marts.hiring_stage(F.col("a"), F.col("b"), F.col("c")))
    assert stage == ["RAPID_EXPANSION", "HIGH_GROWTH", "STEADY_GROWTH",
                     "STEADY_GROWTH", "MODERATE_HIRING", "LIMITED_HIRING"]
    presence = _eval(spark, [(20,), (19,), (10,), (9,), (5,), (4,)], "t long", marts.market_presence(F.col("t")))
    assert presence == ["MAJOR_PLAYER", "ACTIVE_HIRER", "ACTIVE_HIRER", "REGULAR_HIRER", "REGULAR_HIRER",
                        "SELECTIVE_HIRER"]
    strategy = _eval(
        spark,
        [(2, 1, 0, 0, 0), (0, 0, 3, 1, 1), (0, 0, 0, 3, 1), (0, 0, 1, 1, 1)],
        "c long, f long, l long, j long, m long",
        marts.hiring_strategy(F.col("c"), F.col("f"), F.col("l"), F.col("j"), F.col("m")),
    )
    assert strategy == ["CONTRACT_FOCUSED", "LEADERSHIP_HEAVY", "TALENT_DEVELOPMENT", "BALANCED_HIRING"]
    velocity = _eval(spark, [(10, 30), (5, 0)], "a long, b long",
                     marts.hiring_velocity_score(F.col("a"), F.col("b")))
    assert velocity == [4.0, 60.0]


def test_skills_bands(spark):
    level = _eval(spark, [(10,), (9,), (5,), (4,), (2,), (1,)], "r long", marts.demand_level(F.col("r")))
    assert level == ["HIGH_DEMAND", "MODERATE_DEMAND", "MODERATE_DEMAND", "LOW_DEMAND", "LOW_DEMAND",
                     "MINIMAL_DEMAND"]
    ratio = marts.demand_momentum_ratio(F.col("a"), F.col("b"))
    trend = _eval(spark, [(3, 8), (3, 10), (2, 10), (1, 10), (1, 0)], "a long, b long", marts.market_trend(ratio))
    # 1.5 / 1.2 / 0.8 / 0.4 / NULL
    assert trend == ["RAPIDLY_GROWING", "GROWING", "STABLE", "DECLINING", "DECLINING"]
    score = _eval(spark, [(1, 1, 200000.0, 1.0), (1, 1, None, 1.0), (1, 1, 50000.0, None)],
                  "r long, c long, s double, m double",
                  marts.skills_opportunity_score(F.col("r"), F.col("c"), F.col("s"), F.col("m")))
    # 5 + 3 + 20 + 10 ; NULL salary -> 100 ; NULL momentum -> 100 (least skips NULL)
    assert score == [38.0, 100.0, 100.0]


def test_geo_bands(spark):
    size = _eval(spark, [(50,), (49,), (20,), (19,), (10,), (9,), (5,), (4,)], "t long", marts.market_size(F.col("t")))
    assert size == ["MAJOR_MARKET", "SIGNIFICANT_MARKET", "SIGNIFICANT_MARKET", "EMERGING_MARKET",
                    "EMERGING_MARKET", "SMALL_MARKET", "SMALL_MARKET", "MINIMAL_MARKET"]
    act = _eval(spark, [(5, 0), (4, 10), (4, 9), (0, 3), (0, 2)], "w long, m long",
                marts.activity_level(F.col("w"), F.col("m")))
    assert act == ["VERY_ACTIVE", "ACTIVE", "MODERATE", "MODERATE", "QUIET"]
    tier = _eval(spark, [(120000.0,), (119999.0,), (90000.0,), (70000.0,), (1.0,), (0.0,), (None,)], "a double",
                 marts.salary_tier(F.col("a")))
    assert tier == ["HIGH_SALARY", "COMPETITIVE_SALARY", "COMPETITIVE_SALARY", "AVERAGE_SALARY",
                    "BELOW_AVERAGE_SALARY", "SALARY_UNKNOWN", "SALARY_UNKNOWN"]
    div = _eval(spark, [(1, 1, 1, "Major"), (1, 1, 1, "Secondary"), (1, 1, 1, "Suburb"), (5, 5, 10, "Major")],
                "f long, i long, c long, t string",
                marts.market_diversity_score(F.col("f"), F.col("i"), F.col("c"), F.col("t")))
    assert div == [41, 31, 26, 100]
    flex = _eval(spark, [(1, 0, 3), (1, 1, 8)], "c long, p long, t long",
                 marts.flexibility_ratio(F.col("c"), F.col("p"), F.col("t")))
    assert flex == [33.3, 25.0]


def test_moderate_temperature_reached(spark):
    """Five postings inside 30 days but only one inside 7 days -> MODERATE."""
    days = [1, 10, 12, 20, 29]
    rows = [(f"id{i}", "Perth", "WA", "IT", "Director", "Contract", "Co", 1.0, 2.0,
             str(AS_OF - dt.timedelta(days=d))) for i, d in enumerate(days)]
    staged = spark.createDataFrame(
        rows,
        "job_posting_id string, job_city string, job_state string, job_industries string, "
        "job_seniority_level string, job_employment_type string, company_name string, "
        "min_salary double, max_salary double, job_posted_date string",
    )
    out = marts.heatmap(staged, AS_OF).collect()
    assert len(out) == 1
    assert (out[0]["jobs_last_7_days"], out[0]["jobs_last_30_days"]) == (1, 5)
    assert out[0]["market_temperature"] == "MODERATE"


def test_malformed_posted_date_is_not_recent(spark):
    staged = spark.createDataFrame(
        [("a", "Perth", "WA", "IT", "x", "y", "Co", None, None, "yesterday"),
         ("b", "Perth", "WA", "IT", "x", "y", "Co", None, None, "2001-07-31")],
        "job_posting_id string, job_city string, job_state string, job_industries string, "
        "job_seniority_level string, job_employment_type string, company_name string, "
        "min_salary double, max_salary double, job_posted_date string",
    )
    r = marts.heatmap(staged, AS_OF).collect()[0]
    assert (r["job_count"], r["jobs_last_7_days"]) == (2, 1)
    assert r["avg_max_salary"] is None and r["opportunity_index"] == round(0.6931471805599453 * 1.0986122886681098, 2)

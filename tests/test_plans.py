"""Plan checks: no Python evaluation anywhere, broadcast of the fixed dimension,
pruned scans."""

import re

import pytest

import __spark_entry__ as entry
from hirescope.plans import queries as registry
from conftest import SF_SMOKE

SIDE_EFFECT_KEYS = {
    "partitioned_rebuild", "merge_partitioned", "load_availability_csv", "stream_ingest",
    "bronze_lineage", "bronze_rescued", "bronze_drifted", "merge_resume", "merge_interleaved", "stream_drop_late", "pipeline_same_day", "pipeline_orc", "pipeline_models", "pipeline_run", "pipeline_incremental", "pipeline_views", "pipeline_stream",
    "pipeline_bucketed", "heatmap_incremental", "company_incremental", "stream_keep_latest",
}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - SIDE_EFFECT_KEYS))
def test_no_python_udf_in_plan(spark, name):
    plan = _plan(registry.queries()[name](spark, SF_SMOKE))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - SIDE_EFFECT_KEYS))
def test_no_cross_join_in_plan(spark, name):
    """High-water marks are scalar subqueries; every join is an equi-join."""
    plan = _plan(registry.queries()[name](spark, SF_SMOKE))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_geocode_broadcasts_city_dimension(spark):
    plan = _plan(registry.queries()["geocode"](spark, SF_SMOKE))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


def test_orders_scan_is_pruned(spark):
    df = registry.queries()["heatmap_v1"](spark, SF_SMOKE)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" not in text and "o_orderstatus" not in text


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "market_temperature" in df.columns


def test_bucketed_enrichment_inputs_join_without_shuffle(spark):
    import datetime as dt

    from hirescope.operators import enrich
    from hirescope.plans import jobs
    from hirescope.plans import queries as q
    from hirescope.session import work_path

    raw = q._land(spark, SF_SMOKE, work_path(spark, "t-landing"))
    layout = jobs.Layout(work_path(spark, "t-warehouse"), catalog="hs_plan_test", buckets=4)
    jobs.run(spark, raw, layout, dt.date(2001, 8, 1), marts=False)
    r = jobs.Run(spark, layout, dt.date(2001, 8, 1))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too big to broadcast
    try:
        df = enrich(r.table("unified"), r.table("availability"), r.table("ai_summaries"), dt.date(2001, 8, 1))
        plan = _plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan


def _without_broadcast(spark, build):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too big to broadcast
    try:
        return _plan(build())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_unify_shuffles_for_its_joins_only(spark):
    plan = _without_broadcast(spark, lambda: registry.queries()["unify"](spark, SF_SMOKE))
    assert plan.count("Exchange hashpartitioning") == 4


def test_merge_probe_uses_the_buckets(spark):
    from hirescope.operators import matching
    from hirescope.sources.sinks import CatalogTable
    from hirescope.session import work_path

    spark.sql(f"CREATE DATABASE IF NOT EXISTS hs_probe LOCATION '{work_path(spark, 'db')}'")
    rows = spark.range(2000).selectExpr("CAST(id AS STRING) AS k", "id AS v", "CAST(id % 3 AS STRING) AS p")
    for name in ("t", "b"):
        CatalogTable(f"hs_probe.{name}", 4).create(rows, work_path(spark, name), ["p"], ["k"])
    t, b = spark.table("hs_probe.t"), spark.table("hs_probe.b")
    plan = _without_broadcast(spark, lambda: matching(t, b.select("k"), ["k"], "left_semi"))
    complete = plan.split("Union", 1)[1].split(":- ", 1)[1].split("\n+- ", 1)[0]
    first = plan[plan.index("SortMergeJoin") : plan.index("SortMergeJoin", plan.index("SortMergeJoin") + 1)]
    assert "Exchange" not in first, complete
    spark.sql("DROP DATABASE hs_probe CASCADE")


def test_incremental_reads_prune_partitions(spark):
    import datetime as dt

    from hirescope.operators import clean_feed, enrich, stage_active, unify
    from hirescope.plans import jobs
    from hirescope.plans import queries as q
    from hirescope.session import work_path

    raw = q._land(spark, SF_SMOKE, work_path(spark, "t-landing"))
    layout = jobs.Layout(work_path(spark, "t-warehouse"))
    jobs.run(spark, raw, layout, dt.date(2001, 8, 1), marts=False)
    r = jobs.Run(spark, layout, dt.date(2001, 8, 2))
    tiers = {
        "cleaned": clean_feed(r.table("bronze_a"), "a", r.load_ts, target=r.existing("cleaned_a")),
        "unified": unify(r.table("cleaned_b"), r.table("cleaned_a"), target=r.existing("unified")),
        "enriched": enrich(r.table("unified"), r.table("availability"), r.table("ai_summaries"), r.load_ts, target=r.existing("enriched")),
        "staged": stage_active(r.table("enriched"), r.load_ts, target=r.existing("staged")),
    }
    for name, df in tiers.items():
        plan = _plan(df)
        assert re.search(r"PartitionFilters: \[[^\]]*(load_date|year)", plan), name


def test_marts_collect_no_sets_of_raw_rows(spark):
    plan = _plan(registry.queries()["company_metrics"](spark, SF_SMOKE))
    assert "ObjectHashAggregate" not in plan and "collect_set" not in plan


def test_small_batch_prunes_the_histories_by_bloom_filters(spark):
    """Marks are literals, so a batch's scan is known to be small when the
    joins are planned: Spark filters both histories by the batch's keys."""
    import datetime as dt

    from pyspark.sql import functions as F

    from hirescope.operators import enrich
    from hirescope.plans import jobs
    from hirescope.plans import queries as q
    from hirescope.session import work_path

    root = work_path(spark, "t-landing")
    cut = F.lit(q.SPLIT_FIRST).cast("timestamp_ntz")
    raw = q._land(spark, SF_SMOKE, root, F.col("scraped_dts") < cut)
    layout = jobs.Layout(work_path(spark, "t-warehouse"), catalog="hs_bloom_test")
    jobs.run(spark, raw, layout, dt.date(2001, 8, 1), marts=False)
    r = jobs.Run(spark, layout, dt.date(2001, 8, 2))
    confs = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        marks = r.existing("enriched")
        df = enrich(r.table("unified"), r.table("availability"), r.table("ai_summaries"), dt.date(2001, 8, 2), target=marks)
        plan = _plan(df)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.count("might_contain") >= 2
    spark.sql("DROP DATABASE hs_bloom_test CASCADE")


def test_mart_order_survives_the_write(spark):
    import datetime as dt
    import os

    from hirescope.plans import jobs, pipeline
    from hirescope.session import work_path
    from hirescope.sources import write_table

    staged = pipeline.staged_postings(spark, SF_SMOKE)
    for name, score, ties in (("skills_demand", "opportunity_score", None), ("geography", "opportunity_index", ["state", "city"])):
        path = write_table(jobs.MARTS[name](staged, dt.date(2001, 8, 1)), work_path(spark, name))
        folder = path.replace("file:", "")
        files = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
        rows = [r for f in files for r in spark.read.parquet(f"{path}/{f}").collect()]
        scores = [r[score] for r in rows]
        assert len(rows) > 5 and scores == sorted(scores, reverse=True)
        if ties:
            keys = [(-r[score], r["state"] is not None, r["state"] or "", r["city"] is not None, r["city"] or "") for r in rows]
            assert keys == sorted(keys)


def test_company_metrics_deals_postings_to_many_tasks_before_they_are_expanded(spark):
    from hirescope.operators import marts

    staged = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").selectExpr(
        "concat('c', o_custkey) company_name", "'i' job_industries", "'t' job_title", "'f' job_function", "'x' job_city", "'Contract' job_employment_type",
        "'Director' job_seniority_level", "'2001-07-01' job_posted_date", "o_totalprice min_salary", "o_totalprice max_salary")
    plan = marts.company_metrics(staged, "2001-08-01")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Expand") :]
    assert f", {marts.COMPANY_TASKS}), REPARTITION_BY_NUM" in below


def test_company_counts_are_hashed_and_dates_come_from_the_same_exchange(spark):
    from hirescope.operators import marts

    columns = [*marts.COMPANY_KEYS, "job_title", "job_function", "job_city", "job_employment_type", "job_seniority_level", "job_posted_date"]
    keys = [(None, "x"), ("", "x"), ("a", None), ("a", ""), (None, None), (None, "x")]
    rows = [(*k, f"t{i}", "f", "c", "Full-time", "Director", None if k == ("a", "") else f"2001-07-0{i + 1}", 1.0, 2.0) for i, k in enumerate(keys)]
    staged = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns) + ", min_salary double, max_salary double")
    out = marts.company_metrics(staged, "2001-08-01")
    got = {(r.company_name, r.job_industries): (r.unique_roles, r.first_posting_date, r.latest_posting_date) for r in out.collect()}
    day = "2001-07-0{}".format
    assert got == {(None, "x"): (2, day(1), day(6)), ("", "x"): (1, day(2), day(2)), ("a", None): (1, day(3), day(3)), ("a", ""): (1, None, None), (None, None): (1, day(5), day(5))}
    plan = out._jdf.queryExecution().executedPlan().toString()
    counted = [line for line in plan.split("== Initial Plan ==")[0].splitlines() if "Aggregate" in line and "count(" in line]
    assert counted and all("HashAggregate" in line and "ObjectHash" not in line for line in counted)
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("materialize", ["table", "view"])
def test_first_load_drops_repeats_once(spark, tmp_path, monkeypatch, materialize):
    """Models that read tables with one row a key, made by the same run, are not reduced by key again; a later load is."""
    import datetime as dt

    from hirescope.plans import jobs, queries
    from hirescope.sources import fixtures

    reduced = []
    if materialize == "table":
        merge = jobs.merge_into_table
        monkeypatch.setattr(jobs, "merge_into_table", lambda spark, path, *a, order=None, **k: (reduced.append(path.rsplit("/", 1)[1]) if order else None) or merge(spark, path, *a, order=order, **k))
    else:
        latest = jobs.latest_per_key
        monkeypatch.setattr(jobs, "latest_per_key", lambda df, *a: reduced.append(len(df.columns)) or latest(df, *a))
    sf, root = "/root/testdata/sf0.001", str(tmp_path)
    queries._land(spark, sf, f"{root}/raw")
    raw = queries._land(spark, sf, f"{root}/raw")  # every raw row twice
    layout = jobs.Layout(f"{root}/tables", materialize=materialize, view_prefix=f"once_{materialize}_")
    written = jobs.run(spark, raw, layout, fixtures.AS_OF, marts=False, threads=1)
    read = (lambda m: spark.read.parquet(written[m])) if materialize == "table" else (lambda m: spark.table(written[m]))
    for model in jobs.MODELS:
        ids = [r[0] for r in read(model).select("job_posting_id").collect()]
        assert ids and len(ids) == len(set(ids)), model
    if materialize == "view":
        assert len(reduced) == 6
        return
    assert reduced == ["bronze_a", "bronze_b", "availability", "ai_summaries", "unified", "descriptions"]
    reduced.clear()
    jobs.run(spark, raw, layout, fixtures.AS_OF + dt.timedelta(days=1), marts=False, threads=1)
    assert set(reduced) == set(jobs.MODELS)

"""Opt-in fixes (D-13 re-enrichment, D-14 inactive removal) and job reruns."""

import datetime as dt

from pyspark.sql import functions as F

from hirescope.operators.enrich import enrich
from hirescope.plans import jobs
from hirescope.plans import queries as q
from hirescope.session import work_path
from hirescope.sources.sinks import merge_into_table

T1, T2, T3 = dt.datetime(2001, 7, 1), dt.datetime(2001, 7, 2), dt.datetime(2001, 7, 3)


def _unified(spark):
    df = spark.createDataFrame(
        [("1", 1, "Director", None, None, False, True), ("2", 1, "Director", None, None, False, True)],
        "job_posting_id string, job_source int, job_seniority_level string, min_salary double, "
        "max_salary double, is_enriched boolean, is_active boolean",
    )
    for c in ["url", "job_title", "company_name", "job_city", "job_state", "job_country", "job_function",
              "job_employment_type", "job_industries", "job_posted_date", "_rescued_data"]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    return df.withColumns({"scraped_dts": F.lit(T1), "ingest_dts": F.lit(T1)})


def test_reprocess_on_change(spark):
    unified = _unified(spark)
    avail = spark.createDataFrame([("2", False, T1)], "job_posting_id string, is_active boolean, validated_dts timestamp")
    summ = spark.createDataFrame(
        [("1", None, "REMOTE", 50.0, 60.0, "d", "s", T3)],
        "job_posting_id string, job_seniority_level string, workplace_type string, min_salary double, "
        "max_salary double, it_domains string, ai_summaries string, summarized_dts timestamp",
    )
    target = spark.createDataFrame([(T2,)], "enriched_dts timestamp")
    assert enrich(unified, avail, summ, "2001-08-01", target=target).count() == 0  # reference: never revisited
    again = enrich(unified, avail, summ, "2001-08-01", target=target, reprocess_on_change=True).collect()
    assert [(r.job_posting_id, r.min_salary, r.workplace_type) for r in again] == [("1", 50.0, "REMOTE")]


def test_merge_with_deletes(spark):
    schema = "k string, v long, year int, month int, day int"
    path = work_path(spark, "t-del")
    merge_into_table(spark, path, spark.createDataFrame([("a", 1, 2001, 7, 1), ("b", 1, 2001, 7, 2)], schema), ["k"])
    merge_into_table(spark, path, spark.createDataFrame([("c", 1, 2001, 7, 3)], schema), ["k"],
                     delete_keys=spark.createDataFrame([("b",)], "k string"))
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "year", "month", "day").collect())
    assert got == [("a", 1, 2001, 7, 1), ("c", 1, 2001, 7, 3)]
    flat = work_path(spark, "t-del-flat")
    merge_into_table(spark, flat, spark.createDataFrame([("a", 1), ("b", 1)], "k string, v long"), ["k"], partitions=())
    merge_into_table(spark, flat, spark.createDataFrame([], "k string, v long"), ["k"], partitions=(),
                     delete_keys=spark.createDataFrame([("a",)], "k string"))
    assert [tuple(r) for r in spark.read.parquet(flat).collect()] == [("b", 1)]


def test_job_rerun_without_new_files_changes_nothing(spark):
    sf = "/root/testdata/sf0.001"
    raw = q._land(spark, sf, work_path(spark, "t-landing"))
    layout = jobs.Layout(work_path(spark, "t-warehouse"))
    written = jobs.run(spark, raw, layout, dt.date(2001, 8, 1), marts=False)
    before = sorted(map(tuple, spark.read.parquet(written["staged"]).collect()), key=repr)
    jobs.run(spark, raw, layout, dt.date(2001, 8, 2), marts=False)
    after = sorted(map(tuple, spark.read.parquet(written["staged"]).collect()), key=repr)
    assert before == after and len(before) > 0


def test_job_remove_inactive(spark):
    """A posting re-delivered as inactive leaves staging only with the option on."""
    sf = "/root/testdata/sf0.001"
    for remove, expect_kept in ((False, True), (True, False)):
        root = work_path(spark, "t-landing")
        raw = q._land(spark, sf, root)
        layout = jobs.Layout(work_path(spark, "t-warehouse"))
        written = jobs.run(spark, raw, layout, dt.date(2001, 8, 1), marts=False)
        staged = spark.read.parquet(written["staged"])
        victim = staged.orderBy("job_posting_id").first().job_posting_id
        # the availability pool later reports the posting inactive, and the posting is re-scraped
        spark.createDataFrame([(victim, False, dt.datetime(2001, 8, 3))],
                              "job_posting_id string, is_active boolean, validated_dts timestamp") \
            .write.mode("append").option("header", True).csv(raw.availability_csv)
        post = q.fixtures.postings(spark, sf).where(F.col("job_posting_id") == victim) \
            .withColumn("scraped_dts", F.lit(dt.datetime(2001, 8, 3)).cast("timestamp_ntz"))
        feed_a = post.first().job_source == 0
        rescraped = q.fixtures.raw_feed_a(post) if feed_a else q.fixtures.raw_feed_b(post)
        rescraped.write.mode("append").parquet(raw.feed_a if feed_a else raw.feed_b)
        jobs.run(spark, raw, layout, dt.date(2001, 8, 4), marts=False, remove_inactive=remove)
        kept = spark.read.parquet(written["staged"]).where(F.col("job_posting_id") == victim).count()
        assert (kept == 1) is expect_kept


def test_load_without_a_later_stamp_is_refused(spark):
    import pytest

    sf = "/root/testdata/sf0.001"
    for mode in ("files", "stream"):
        root = work_path(spark, "t-landing")
        cut = F.lit(q.SPLIT_FIRST).cast("timestamp_ntz")
        raw = q._land(spark, sf, root, F.col("scraped_dts") < cut)
        layout = jobs.Layout(work_path(spark, "t-warehouse"))
        jobs.run(spark, raw, layout, dt.date(2001, 8, 1), marts=False, bronze_mode=mode)
        jobs.run(spark, raw, layout, dt.date(2001, 8, 1), marts=False, bronze_mode=mode)  # nothing new: fine
        q._land(spark, sf, root, F.col("scraped_dts") >= cut, side_tables=False)
        with pytest.raises(Exception, match="not later than the last load"):
            jobs.run(spark, raw, layout, dt.date(2001, 8, 1), marts=False, bronze_mode=mode)
        written = jobs.run(spark, raw, layout, dt.date(2001, 8, 1), marts=False, bronze_mode=mode, load_ts=dt.datetime(2001, 8, 1, 9))
        ids = spark.read.parquet(written["unified"]).select("job_posting_id")
        assert ids.count() == ids.distinct().count() == q.fixtures.postings(spark, sf).count()


def test_stream_bronze_into_catalog_tables(spark):
    """Two loads with a file stream and catalog tables: marks are kept, the
    caller's time zone is left as it was."""
    sf = "/root/testdata/sf0.001"
    root = work_path(spark, "t-landing")
    cut = F.lit(q.SPLIT_FIRST).cast("timestamp_ntz")
    raw = q._land(spark, sf, root, F.col("scraped_dts") < cut)
    layout = jobs.Layout(work_path(spark, "t-warehouse"), catalog="hs_stream_catalog")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
    try:
        jobs.run(spark, raw, layout, dt.date(2001, 8, 1), marts=False, bronze_mode="stream")
        q._land(spark, sf, root, F.col("scraped_dts") >= cut, side_tables=False)
        jobs.run(spark, raw, layout, dt.date(2001, 8, 2), marts=False, bronze_mode="stream")
        assert spark.conf.get("spark.sql.session.timeZone") == "Australia/Sydney"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    ids = spark.table("hs_stream_catalog.unified").select("job_posting_id")
    assert ids.count() == ids.distinct().count() == q.fixtures.postings(spark, sf).count()
    marks = jobs.Run(spark, layout, dt.date(2001, 8, 3)).existing("unified")
    assert spark.range(1).select(marks["ingest_dts"]).first()[0] == spark.table("hs_stream_catalog.unified").agg(F.max("ingest_dts")).first()[0]
    spark.sql("DROP DATABASE hs_stream_catalog CASCADE")


def test_cluster_session_without_shared_folder_is_refused(monkeypatch):
    import pytest

    from hirescope import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())

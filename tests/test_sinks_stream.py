"""Partition-limited merge, CSV source and the availableNow file ingest."""

import os

from pyspark.sql import functions as F

from hirescope.operators import load_availability, unreadable_flags
from hirescope.session import work_path
from hirescope.sources import fixtures, read_availability_csv
from hirescope.sources.sinks import merge_into_table
from hirescope.streaming import ingest_files

SCHEMA = "k string, v long, year int, month int, day int"


def _table(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).select("k", "v", "year", "month", "day").collect()),
                  key=repr)


def test_merge_moves_key_and_drops_emptied_partition(spark):
    path = work_path(spark, "t-merge")
    first = spark.createDataFrame([("a", 1, 2001, 7, 30), ("b", 1, 2001, 7, 30), ("c", 1, 2001, 7, 31)], SCHEMA)
    merge_into_table(spark, path, first, ["k"])
    second = spark.createDataFrame([("a", 2, 2001, 8, 1), ("b", 2, 2001, 8, 1), ("d", 1, 2001, 8, 1)], SCHEMA)
    merge_into_table(spark, path, second, ["k"])
    expected = sorted([("a", 2, 2001, 8, 1), ("b", 2, 2001, 8, 1), ("c", 1, 2001, 7, 31), ("d", 1, 2001, 8, 1)],
                      key=repr)
    assert _table(spark, path) == expected
    assert not os.path.exists(path.replace("file:", "") + "/year=2001/month=7/day=30")
    merge_into_table(spark, path, second, ["k"])  # replaying a batch changes nothing
    assert _table(spark, path) == expected


def test_merge_dedupes_repeated_key_in_batch(spark):
    path = work_path(spark, "t-merge-dup")
    batch = spark.createDataFrame([("a", 1, 2001, 8, 1), ("a", 3, 2001, 8, 1), ("a", 2, 2001, 8, 1)], SCHEMA)
    merge_into_table(spark, path, batch, ["k"], order=["v"])
    assert _table(spark, path) == [("a", 3, 2001, 8, 1)]


def test_availability_csv_keeps_bad_rows_aside(spark):
    path = work_path(spark, "t-csv")
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(path.replace("file:", "") + "/pool.csv", "w") as fh:
        fh.write("job_posting_id,is_active,validated_dts\n1,true,2001-07-01 10:00:00\n2,maybe,2001-07-01 10:00:00\n"
                 "3,1,2001-07-01 10:00:00\n4,0,2001-07-01 10:00:00\n")
    rows = {r.job_posting_id: r for r in read_availability_csv(spark, path).collect()}
    assert rows["1"].is_active == "true" and rows["1"]._corrupt_record is None
    raw = read_availability_csv(spark, path)
    assert {r.job_posting_id: r.is_active for r in load_availability(raw, "2001-08-01").collect()} == {"1": True, "2": None, "3": True, "4": False}
    assert [(r.job_posting_id, r.is_active) for r in unreadable_flags(raw).collect()] == [("2", "maybe")]


def test_stream_ingest_only_new_files_and_late_rows(spark):
    posts = fixtures.postings(spark, "/root/testdata/sf0.001")
    raw = fixtures.raw_feed_a(posts)
    landing, target, ckpt = (work_path(spark, n) for n in ("t-land", "t-target", "t-ckpt"))
    early = raw.where(F.col("timestamp") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    early.repartition(2, "job_posting_id").write.mode("append").parquet(landing)
    ingest_files(spark, landing, "a", target, ckpt, fixtures.AS_OF, max_files_per_trigger=1)
    n1 = spark.read.parquet(target).count()
    assert n1 == early.count()
    ingest_files(spark, landing, "a", target, ckpt, fixtures.AS_OF)  # nothing new
    assert spark.read.parquet(target).count() == n1
    # a new file holding rows older than everything already loaded: still ingested
    late = raw.where(F.col("timestamp") < F.lit("1998-01-01").cast("timestamp_ntz"))
    late.write.mode("append").parquet(landing)
    ingest_files(spark, landing, "a", target, ckpt, fixtures.AS_OF)
    assert spark.read.parquet(target).count() == raw.count()
    assert spark.read.parquet(target).select("job_posting_id").distinct().count() == raw.count()


def test_stream_ingest_parity_mode_drops_late_rows(spark):
    posts = fixtures.postings(spark, "/root/testdata/sf0.001")
    raw = fixtures.raw_feed_a(posts)
    landing, target, ckpt = (work_path(spark, n) for n in ("t-land", "t-target", "t-ckpt"))
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    early = raw.where(F.col("timestamp") >= cut)
    early.write.parquet(landing)
    ingest_files(spark, landing, "a", target, ckpt, fixtures.AS_OF, drop_late=True)
    raw.where(F.col("timestamp") < cut).write.mode("append").parquet(landing)
    ingest_files(spark, landing, "a", target, ckpt, fixtures.AS_OF, drop_late=True)
    assert spark.read.parquet(target).count() == early.count()


def test_merge_drops_emptied_partition_with_escaped_value(spark):
    path = work_path(spark, "t-esc")
    schema = "k string, v long, part string"
    merge_into_table(spark, path, spark.createDataFrame([("a", 1, "x:1/2"), ("b", 1, "y")], schema), ["k"],
                     partitions=("part",))
    merge_into_table(spark, path, spark.createDataFrame([("a", 2, "y")], schema), ["k"], partitions=("part",))
    rows = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "part").collect())
    assert rows == [("a", 2, "y"), ("b", 1, "y")]
    assert [d for d in os.listdir(path.replace("file:", "")) if not d.startswith(("_", "."))] == ["part=y"]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_ROW = st.tuples(st.sampled_from(["a", "b", "c", "d", "e"]), st.integers(1, 3))  # key, partition


@settings(max_examples=int(__import__("os").environ.get("MERGE_EXAMPLES", "4")), deadline=None)
@given(st.lists(st.lists(_ROW, min_size=1, max_size=6), min_size=2, max_size=3))
def test_merge_sequence_equals_latest_of_all(spark, batches):
    from hirescope.operators import latest_per_key

    schema = "k string, v long, p int"
    path = work_path(spark, "t-prop")
    version, everything = 0, []
    for rows in batches:
        batch = []
        for k, p in rows:
            version += 1
            batch.append((k, version, p))
        everything += batch
        merge_into_table(spark, path, spark.createDataFrame(batch, schema), ["k"], partitions=("p",), order=["v"])
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "p").collect())
    want = sorted(tuple(r) for r in latest_per_key(spark.createDataFrame(everything, schema), ["k"], ["v"]).collect())
    assert got == want


def test_rescue_keeps_values_that_do_not_fit(spark):
    import json

    from hirescope.sources import read_raw_feed

    path = work_path(spark, "t-rescue")
    drifted = spark.createDataFrame(
        [("1", "12.5", "extra-1", "2001-07-01"), ("2", "n/a", None, "2001-07-02")],
        "job_posting_id string, MIN_AMOUNT string, new_col string, job_posted_date string",
    )
    drifted.write.parquet(path)
    rows = {r.job_posting_id: r for r in read_raw_feed(spark, path, "a", rescue=True).collect()}
    assert rows["1"].MIN_AMOUNT == 12.5 and rows["1"].MAX_AMOUNT is None
    assert json.loads(rows["1"]._rescued_data) == {"new_col": "extra-1"}
    assert rows["2"].MIN_AMOUNT is None and json.loads(rows["2"]._rescued_data) == {"MIN_AMOUNT": "n/a"}
    assert read_raw_feed(spark, path, "a", rescue=True).columns == read_raw_feed(spark, path, "a").columns


def test_merge_into_bucketed_catalog_table(spark):
    from hirescope.sources.sinks import CatalogTable

    spark.sql(f"CREATE DATABASE IF NOT EXISTS hs_merge_test LOCATION '{work_path(spark, 'db')}'")
    table = CatalogTable("hs_merge_test.t", buckets=4)
    path = work_path(spark, "t-cat")
    schema = "k string, v long, p int"
    merge_into_table(spark, path, spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], schema), ["k"],
                     partitions=("p",), table=table)
    merge_into_table(spark, path, spark.createDataFrame([("c", 1, 2)], schema), ["k"], partitions=("p",),
                     table=table)  # new key only: appended
    merge_into_table(spark, path, spark.createDataFrame([("a", 2, 2)], schema), ["k"], partitions=("p",),
                     table=table)  # key moves from p=1 to p=2
    got = sorted(tuple(r) for r in spark.table(table.name).select("k", "v", "p").collect())
    assert got == [("a", 2, 2), ("b", 1, 1), ("c", 1, 2)]
    desc = " ".join(str(r) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table.current(spark)}").collect())
    assert "Num Buckets" in desc
    table.drop(spark)
    assert not table.exists(spark)


def test_unpartitioned_merge_appends_new_keys_and_rewrites_on_replace(spark):
    path = work_path(spark, "t-flat")
    schema = "k string, v long"
    merge_into_table(spark, path, spark.createDataFrame([("a", 1)], schema), ["k"], partitions=())
    merge_into_table(spark, path, spark.createDataFrame([("b", 1)], schema), ["k"], partitions=())
    merge_into_table(spark, path, spark.createDataFrame([("a", 2), ("c", 1)], schema), ["k"], partitions=())
    merge_into_table(spark, path, spark.createDataFrame([("c", 1)], schema), ["k"], partitions=())
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 2), ("b", 1), ("c", 1)]


def _catalog(spark, **named):
    from hirescope.plans.queries import _merge_catalog

    return _merge_catalog(spark, **named)


def _rows(df):
    return sorted((tuple(r) for r in df.select("k", "v", "p").collect()), key=repr)


def test_merges_lost_before_their_commit_change_nothing(spark):
    """A merge that is staged and never published, in either kind of table:
    readers see the old version, the next merge starts from it."""
    from hirescope.sources import sinks

    schema = "k string, v long, p int"
    make = lambda rows: spark.createDataFrame(rows, schema)
    for partitions in (["p"], []):
        table, path = _catalog(spark)
        merge_into_table(spark, path, make([("a", 1, 1), ("b", 1, 1), ("c", 1, 2)]), ["k"], partitions, table=table)
        old = _rows(table.read(spark))
        sinks.stage_merge(spark, path, make([("a", 2, 3), ("z", 9, 1)]), ["k"], partitions, True, None, table)
        assert _rows(table.read(spark)) == old
        merge_into_table(spark, path, make([("a", 2, 3), ("d", 2, 2), ("b", 2, 3)]), ["k"], partitions, table=table)
        merge_into_table(spark, path, make([("e", 3, 4), (None, 3, 4)]), ["k"], partitions, table=table)
        want = [("a", 2, 3), ("b", 2, 3), ("c", 1, 2), ("d", 2, 2), ("e", 3, 4), (None, 3, 4)]
        assert _rows(table.read(spark)) == sorted(want, key=repr)
        merge_into_table(spark, path, make([]), ["k"], partitions, delete_keys=spark.createDataFrame([("e",), (None,)], "k string"), table=table)
        assert _rows(table.read(spark)) == sorted(want[:4], key=repr)
        # what the lost merge wrote is gone as well
        assert table.unpublished(spark) == [] and len(os.listdir(path.replace("file:", ""))) <= 4


def test_a_reader_keeps_the_version_it_was_planned_on(spark):
    schema = "k string, v long, p int"
    table, path = _catalog(spark)
    readers, wanted = [], []
    for n in range(4):
        batch = spark.createDataFrame([("a", n, n), (f"b{n}", n, 0)], schema)
        merge_into_table(spark, path, batch, ["k"], ["p"], table=table)
        readers.append(table.read(spark))
        wanted.append(sorted([("a", n, n), *((f"b{i}", i, 0) for i in range(n + 1))], key=repr))
        for reader, want in zip(readers[-3:], wanted[-3:]):  # the current one and two older ones
            assert _rows(reader) == want
    assert table.versions(spark) == [2, 3, 4]
    # the first merge's folder held p=0 (still read) and p=1... of "a" at n=0 (p=0): what no kept version refers to is gone
    specs = set().union(*(table.partitions(spark, n) for n in table.versions(spark)))
    left = {os.path.relpath(d, path.replace("file:", "")) for d, _, files in os.walk(path.replace("file:", "")) if any(f.endswith(".parquet") for f in files)}
    assert {d.split("/", 1)[1] for d in left} == specs


def test_the_second_of_two_writers_is_refused(spark):
    import pytest

    from hirescope.sources import sinks

    schema = "k string, v long, p int"
    table, path = _catalog(spark)
    merge_into_table(spark, path, spark.createDataFrame([("a", 1, 1)], schema), ["k"], ["p"], table=table)
    stage = lambda rows: sinks.stage_merge(spark, path, spark.createDataFrame(rows, schema), ["k"], ["p"], True, None, table)
    one, two = stage([("a", 2, 1)]), stage([("a", 3, 2)])
    two()
    with pytest.raises(RuntimeError, match="committed first"):
        one()
    assert _rows(table.read(spark)) == [("a", 3, 2)]
    merge_into_table(spark, path, spark.createDataFrame([("a", 4, 1)], schema), ["k"], ["p"], table=table)
    assert _rows(table.read(spark)) == [("a", 4, 1)]


@settings(max_examples=int(__import__("os").environ.get("MERGE_EXAMPLES", "3")), deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from([1, 2, None])), max_size=5), min_size=2, max_size=4))
def test_catalog_merge_sequence_equals_latest_of_all(spark, batches):
    from hirescope.operators import latest_per_key

    schema = "k string, v timestamp, p int"
    table, path = _catalog(spark, marks=["v"])
    everything, n = [], 0
    for rows in batches:
        batch = []
        for k, p in rows:
            n += 1
            batch.append((k, __import__("datetime").datetime(2001, 1, 1, 0, 0, n), p))
        everything += batch
        merge_into_table(spark, path, spark.createDataFrame(batch, schema), ["k"], ["p"], order=["v"], table=table)
        want = latest_per_key(spark.createDataFrame(everything, schema), ["k"], ["v"])
        assert _rows(table.read(spark)) == _rows(want)
        mark = spark.range(1).select(table.kept_marks(spark)["v"]).first()[0]
        assert mark == max((r[1] for r in everything), default=None)


def test_path_merge_repeated_after_any_step_is_whole(spark):
    """Steps of a merge into a path table, done by hand up to one of them:
    no row is missing, and the same merge makes the table whole."""
    schema = "k string, v long, p int"
    batch = spark.createDataFrame([("a", 2, 3), ("d", 2, 2), ("b", 2, 3)], schema)
    for steps in range(3):
        path = work_path(spark, "t-steps")
        merge_into_table(spark, path, spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("c", 1, 2)], schema), ["k"], ["p"])
        if steps > 0:  # rows of other partitions appended
            batch.where("p = 3").write.mode("append").partitionBy("p").parquet(path)
        if steps > 1:  # a touched partition overwritten
            spark.createDataFrame([("c", 1, 2), ("d", 2, 2)], schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("p").parquet(path)
        assert {r["k"] for r in spark.read.parquet(path).collect()} >= {"a", "b", "c"}
        merge_into_table(spark, path, batch, ["k"], ["p"])
        assert _rows(spark.read.parquet(path)) == [("a", 2, 3), ("b", 2, 3), ("c", 1, 2), ("d", 2, 2)]


def test_stream_rescues_drifted_files(spark):
    landing, target, ckpt = (work_path(spark, n) for n in ("t-land", "t-target", "t-ckpt"))
    raw = fixtures.raw_feed_a(fixtures.postings(spark, "/root/testdata/sf0.001")).drop("_rescued_data").limit(20)
    raw.withColumn("recruiter", F.lit("r")).withColumn("MIN_AMOUNT", F.lit("n/a")).write.parquet(landing)
    ingest_files(spark, landing, "a", target, ckpt, fixtures.AS_OF)
    rows = spark.read.parquet(target).select("min_salary", "_rescued_data").collect()
    assert len(rows) == 20 and all(r.min_salary is None and '"recruiter":"r"' in r._rescued_data and "n/a" in r._rescued_data for r in rows)


def test_failed_stream_raises(spark):
    import pytest

    from hirescope.streaming.ingest import merge_files

    landing, target, ckpt = (work_path(spark, n) for n in ("t-land", "t-target", "t-ckpt"))
    fixtures.raw_feed_a(fixtures.postings(spark, "/root/testdata/sf0.001")).limit(5).write.parquet(landing)

    def refuse(batch):
        raise ValueError("refused")

    with pytest.raises(Exception, match="refused"):
        merge_files(spark, landing, "a", lambda b: b, target, ckpt, check=refuse)
    assert not spark.streams.active


def test_files_that_contradict_each_other_all_load(spark):
    """Double, text and struct for one column, and a struct with other fields:
    interleaved files, whatever their order."""
    import json

    from hirescope.sources import read_raw_feed

    path = work_path(spark, "t-drift")
    shapes = [("MIN_AMOUNT double", 1.5), ("MIN_AMOUNT string", "n/a"), ("MIN_AMOUNT struct<from:int>", (7,)), ("MIN_AMOUNT string", "2.5"), ("MIN_AMOUNT double", 3.5)]
    for i, (column, value) in enumerate(shapes):
        spark.createDataFrame([(str(i), value)], f"job_posting_id string, {column}").coalesce(1).write.parquet(f"{path}/f{i}")
    rows = {r.job_posting_id: r for r in read_raw_feed(spark, [f"{path}/f{i}" for i in range(5)], "a").collect()}
    assert {k: r.MIN_AMOUNT for k, r in rows.items()} == {"0": 1.5, "1": None, "2": None, "3": 2.5, "4": 3.5}
    rescued = {k: json.loads(r._rescued_data) for k, r in rows.items() if r._rescued_data}
    assert rescued == {"1": {"MIN_AMOUNT": "n/a"}, "2": {"MIN_AMOUNT": '{"from":7}'}}
    assert all(f"/f{k}/" in r.source_file for k, r in rows.items())

    nested = work_path(spark, "t-drift-b")
    spark.createDataFrame([("1", ("5.5", "x", "EUR"))], "job_posting_id string, base_salary struct<min_amount:string,max_amount:string,currency:string>").write.parquet(nested)
    spark.createDataFrame([("2", (1.0, 2.0))], "job_posting_id string, base_salary struct<min_amount:double,max_amount:double>").write.mode("append").parquet(nested)
    rows = {r.job_posting_id: r for r in read_raw_feed(spark, nested, "b").collect()}
    assert tuple(rows["1"].base_salary) == (5.5, None) and tuple(rows["2"].base_salary) == (1.0, 2.0)
    assert json.loads(rows["1"]._rescued_data) == {"base_salary.max_amount": "x", "base_salary.currency": "EUR"}
    assert rows["2"]._rescued_data is None


def test_stream_keeps_the_latest_of_a_posting_across_batches_and_restarts(spark):
    from hirescope.streaming import ingest_latest

    landing, target, late, ckpt = (work_path(spark, n) for n in ("t-land", "t-target", "t-late", "t-ckpt"))
    raw = fixtures.raw_feed_a(fixtures.postings(spark, "/root/testdata/sf0.001")).orderBy("job_posting_id").limit(30)
    day = lambda n: F.col("timestamp") + F.expr(f"INTERVAL {n} DAYS")
    at = lambda df, n, title: df.withColumns({"timestamp": day(n), "job_title": F.lit(title)}).coalesce(1)
    ids = [r.job_posting_id for r in raw.select("job_posting_id").collect()]
    run = lambda: ingest_latest(spark, landing, "a", target, ckpt, fixtures.AS_OF, late)
    at(raw, 0, "first").write.mode("append").parquet(landing)
    run()
    some = raw.where(F.col("job_posting_id").isin(ids[:10]))
    at(some, 5, "newer").write.mode("append").parquet(landing)
    run()  # a new stream that knows the state
    at(some, 3, "between").unionByName(at(raw.where(F.col("job_posting_id").isin(ids[10:12])), -1, "older")).coalesce(1).write.mode("append").parquet(landing)
    at(some, 5, "newer").write.mode("append").parquet(landing)  # delivered again
    spark.createDataFrame([(None, "no id")], "job_posting_id string, job_title string").coalesce(1).write.mode("append").parquet(landing)
    run()
    titles = {r.job_posting_id: r.job_title for r in spark.read.parquet(target).collect()}
    assert titles == {i: "newer" if i in ids[:10] else "first" for i in ids}
    aside = sorted((str(r.job_posting_id), r.job_title) for r in spark.read.parquet(late).collect())
    assert aside == sorted([*((i, "between") for i in ids[:10]), *((i, "older") for i in ids[10:12]), ("None", "no id")])
    # rows come back exactly as they were
    original = {r.job_posting_id: r for r in raw.collect()}
    for r in spark.read.parquet(late).where("job_title = 'between'").collect():
        o = original[r.job_posting_id]
        assert (r.MIN_AMOUNT, r.company_name, r.timestamp) == (o.MIN_AMOUNT, o.company_name, o.timestamp + __import__("datetime").timedelta(days=3))


def test_keep_latest_state_handles_all_keys_of_a_bucket_in_one_call():
    import pandas as pd

    from hirescope.streaming.latest import LatestOfKey

    class State:
        value, calls = None, 0

        def exists(self):
            return self.value is not None

        def get(self):
            State.calls += 1
            return self.value

        def update(self, value):
            State.calls += 1
            self.value = value

    class Handle:
        state = State()

        def getValueState(self, *_):
            return self.state

    class At:
        def __init__(self, now):
            self.now = now

        def getCurrentProcessingTimeInMs(self):
            return self.now

    processor, day = LatestOfKey(1), 24 * 3600 * 1000
    processor.init(Handle())

    def call(now, *chunks):
        frames = (pd.DataFrame(c, columns=["name", "event", "payload"]) for c in chunks)
        out = pd.concat([pd.DataFrame({"payload": [], "arrival": []}), *processor.handleInputRows((7,), frames, At(now))])
        return sorted(map(tuple, out[["arrival", "payload"]].itertuples(index=False)))

    names = [f"k{i}" for i in range(500)]
    # two rows a key over two chunks: the newest is new, the other superseded
    assert call(0, [(n, 5, f"{n}@5") for n in names], [(n, 6, f"{n}@6") for n in names]) == sorted(("new", f"{n}@6") for n in names)
    assert State.calls == 1, "one update for all keys"
    assert call(1, [("k0", 6, "again"), ("k1", 5, "old"), ("k2", 9, "a"), ("k2", 9, "b"), ("x", 1, "x")]) == [("late", "old"), ("new", "b"), ("new", "x")]
    assert State.calls == 3
    # a key's state expires on its own: k2 was newer later than k0
    assert call(day, [("k0", 1, "k0 new again"), ("k2", 1, "k2 late")]) == [("late", "k2 late"), ("new", "k0 new again")]


def test_a_load_that_touches_old_partitions_is_not_written_by_one_task(spark):
    path = work_path(spark, "t-merge-tasks")
    rows = lambda ids, p: spark.createDataFrame([(i, p) for i in ids], "k long, p string").repartition(6)
    merge_into_table(spark, path, rows(range(400), "a"), ["k"], ["p"])
    merge_into_table(spark, path, rows(range(399, 800), "b"), ["k"], ["p"])
    table = spark.read.parquet(path)
    assert sorted((r.k, r.p) for r in table.collect()) == [(k, "a" if k < 399 else "b") for k in range(800)]
    files = table.where("p = 'b'").select(F.input_file_name()).distinct().count()
    assert files > 1, "the load was shuffled by its date"

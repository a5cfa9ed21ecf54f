"""Exact deduplication against plain Python groups."""

import hashlib
from collections import defaultdict

import duckdb
import pytest

from pyspark.sql import functions as F

from hirescope.llm import exact_dedup, queries


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    top = lambda ids: max((i for i in ids if i is not None), default=None)
    return sorted((str(i), str(top(groups[t or ""])), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)


def decided(df):
    return sorted((str(r[0]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_groups(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_exact_dedup(spark, f"/root/testdata/{sf}")
    assert decided(got) == brute([tuple(r) for r in rows])
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got.collect())


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(queries.ORACLE["op13_exact_dedup"]).fetchall()
    got = queries.op13_exact_dedup(spark, sf).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def _odd(spark):
    long = "a b " * 300_000
    rows = [(1, "x"), (2, "x "), (3, "X"), (4, None), (5, ""), (6, long), (7, long), (7, long), (8, "x"), (8, "x"), (None, "x"), (None, "lone"), (None, "é"), (9, "é")]
    return spark.createDataFrame([(*r, n, "s") for n, r in enumerate(rows)], "doc_id long, text string, row int, digest string"), rows


def test_edge_cases(spark):
    df, rows = _odd(spark)
    got = exact_dedup.copies(df)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert decided(got) == brute(rows)
    kept = got.where("kept").groupBy("text_sha256").count().collect()
    assert len(kept) == len({t or "" for _, t in rows}) and all(r["count"] == 1 for r in kept)
    assert exact_dedup.copies(df.limit(0)).count() == 0
    folded = exact_dedup.copies(df, normalise=lambda t: F.lower(F.trim(t)))
    assert {r["keep_id"] for r in folded.where("doc_id in (1, 2, 3)").collect()} == {8}


@pytest.mark.parametrize("counters", [8, 4096])
def test_frequent_and_rare_digests_are_decided_alike(spark, counters):
    """A third of the rows is one text, some are common, most are alone; with
    few counters most common ones go the ordinary way."""
    text = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 1, F.concat(F.lit("warm "), F.col("id") % 5)).otherwise(F.col("id").cast("string"))
    df = spark.range(0, 6000, numPartitions=16).select(F.col("id").alias("doc_id"), text.alias("text")).withColumn("text", F.coalesce("text", F.lit("")))
    table = exact_dedup.digest_table(df)
    rows, heavy = exact_dedup.split(table, counters)
    hot = hashlib.sha256(b"hot").hexdigest()
    winners = {r["digest"]: (r["stays"]["id"], r["group_size"]) for r in heavy.collect()}
    assert winners[hot] == (5997, 2000) and len(winners) <= counters
    assert decided(exact_dedup.copies(df, counters=counters)) == brute([tuple(r) for r in df.collect()])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not any(k in plan for k in ("Python", "Arrow", "Pandas"))


def test_rows_that_stay_keep_their_columns(spark):
    df, rows = _odd(spark)
    stay = exact_dedup.drop_copies(df)
    assert stay.columns == df.columns
    got = sorted((str(r["doc_id"]), r["text"] or "") for r in stay.collect())
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    assert got == sorted((str(max((i for i in ids if i is not None), default=None)), t) for t, ids in groups.items())
    assert all(df.where(F.col("row") == r["row"]).first() == r for r in stay.collect())

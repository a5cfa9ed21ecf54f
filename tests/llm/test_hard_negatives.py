"""Hard negatives against all scores in plain Python."""

import math

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F

from hirescope.llm import hard_negatives, queries


def brute(rows, anchors, low=30, high=90, scale=256, k=5, m=10):
    """rows: (id, label, vector), one for each id."""
    rows = [(i, lab, [math.floor(scale * float(x)) for x in v]) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, label, v in rows:
        if not anchors(a):
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), i, lab) for i, lab, w in rows if i != a and len(w) == len(v))
        for p, i, _ in [s for s in scores if s[2] == label][:k]:
            fit = [(-s, j) for s, j, lab in scores if lab != label and low * -p <= 100 * -s <= high * -p]
            out += [(a, i, rank, j, -p, s) for rank, (s, j) in enumerate(fit[:m], 1)]
    return sorted(out)


def found(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_against_sql_and_brute_force(spark, sf):
    got = found(queries.op11_hard_negatives(spark, f"/root/testdata/{sf}"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('/root/testdata/{sf}/embeddings.parquet')")
    assert got == sorted(con.execute(queries.ORACLE["op11_hard_negatives"]).fetchall())
    rows = con.execute("SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END, embedding FROM embeddings").fetchall()
    if sf == "sf0.001":
        assert got == brute(rows, lambda i: i % 100 == 0)
    assert len({r[0] for r in got}) > 1


def test_stripes_blocks_and_clustered_anchors(spark):
    """Many stripes and blocks; a third of the rows are near copies, so bounds
    leave rows out, and a third share one label."""
    rng = np.random.default_rng(11)
    vectors = rng.standard_normal((900, 6)) * rng.lognormal(0, 1, (900, 1))
    vectors[300:600] = vectors[300] + 0.01 * rng.standard_normal((300, 6))
    rows = [(i, "hot" if i % 3 == 0 else f"l{i % 40}", v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    want = brute(rows, lambda i: i % 9 == 0)
    for stripe, block in ((100, 7), (5000, 256)):
        assert found(hard_negatives.mine(df, F.col("vec_id") % 9 == 0, F.col("label"), stripe=stripe, block=block)) == want


def test_edge_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, i % 3, [float((i * 7) % 5), float(i % 4) - 1.5]) for i in range(1, 40)]
    rows += [(50, 1, [1.0, 2.0, 3.0]), (51, 1, [3.0, 1.0, 1.0]), (52, 2, [1.0, 1.0, 1.0]), (60, 1, []), (61, 2, []), (62, 1, []), (65, 2, [0.0, 0.0])]
    bad = [(70, None, [1.0, 1.0]), (75, 1, None), (80, 1, [1.0, None]), (85, 1, [nan, 1.0]), (90, 1, [inf, 1.0]), (None, 1, [1.0, 1.0])]
    repeated = [rows[4], rows[4], (5, 9, [9.0, 9.0])]  # the smallest label and vector of an id counts
    df = spark.createDataFrame([(*r, 1, "s") for r in rows + bad + repeated], "vec_id long, label int, embedding array<float>, stripe int, dim string")
    mine = lambda d, **named: found(hard_negatives.mine(d, F.col("vec_id") % 5 == 0, F.col("label"), **named))
    assert mine(df, stripe=9, block=3) == brute(rows, lambda i: i % 5 == 0)
    assert mine(df, low=-50, high=300, positives=2, negatives=100) == brute(rows, lambda i: i % 5 == 0, -50, 300, k=2, m=100)
    assert mine(df.limit(0)) == [] == mine(df.where("vec_id % 5 <> 0"))


def test_scores_beyond_double_precision_are_exact(spark):
    rows = [(i, i % 2, [float(2**22 + i), float(2**22 - 3 * i), 1.0 + i]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    args = {"low": 0, "high": 100, "scale": 256}
    got = found(hard_negatives.mine(df, F.col("vec_id") % 10 == 0, F.col("label"), **args))
    assert got == brute(rows, lambda i: i % 10 == 0, 0, 100) and got[0][4] > 2**53
    with pytest.raises(Exception, match="OverflowError|too large|too big"):
        hard_negatives.mine(df, F.col("vec_id") % 10 == 0, F.col("label"), scale=10**9).collect()


def test_bounds_leave_rows_out():
    """Anchors in a tight cluster: rows are scored at the first anchor, and then only near the window."""
    rng = np.random.default_rng(3)
    rows = hard_negatives.Vectors(rng.integers(-1000, 1000, (4000, 16)))
    anchors = hard_negatives.Vectors(rows.whole[0] + rng.integers(-3, 4, (20, 16)))
    asked = []

    def choose(anchor, low, high):
        truth = rows.whole @ anchors.whole[anchor]
        assert (low <= truth).all() and (truth <= high).all()
        at = np.nonzero((high >= 2_000_000) & (low <= 3_000_000))[0]
        asked.append(len(at))
        return at

    for anchor, at, scores in hard_negatives.walk(anchors, rows, choose):
        truth = rows.whole @ anchors.whole[anchor]
        assert (truth[at] == scores).all()
        assert set(np.nonzero((truth >= 2_000_000) & (truth <= 3_000_000))[0]) <= set(at.tolist())
    assert max(asked) < 1500

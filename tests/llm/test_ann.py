"""Approximate nearest neighbours: recall and exact scores against brute force."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from hirescope.llm import ann, queries


def brute(ids, vectors, q, k):
    scores = [sum(a * b for a, b in zip(v, vectors[q])) for v in vectors]
    order = sorted((-s, i) for s, i in zip(scores, ids) if i != ids[q])
    return [(i, -s) for s, i in order[:k]]


def collect(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_small_tables_are_exact(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [float(x) for x in np.random.default_rng(i).integers(-2, 3, 3)]) for i in range(1, 26)]
    rows = [(i, v if any(v) else [1.0, 0.0, 0.0]) for i, v in rows]
    bad = [(40, None), (60, []), (80, [0.0, 0.0, 0.0]), (100, [1.0, None, 2.0]), (120, [1.0, nan, 0.0]), (140, [inf, 0.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    other = [(160, [1.0, 2.0]), (161, [3.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in [*rows, rows[4], *bad, *other]], "vec_id long, embedding array<float>, score int")
    got = collect(ann.search(df, F.col("vec_id") % 5 == 0, k=4, block=7, query_block=2))
    ids, vectors = [i for i, _ in rows], [v for _, v in rows]
    for n, q in enumerate(ids):
        if q % 5 == 0:
            want = brute(ids, vectors, n, 4)
            # blocks of seven are verified whole
            assert [(v, s) for _, v, s in got[q]] == want and [r for r, _, _ in got[q]] == [1, 2, 3, 4]
    assert got[160] == [(1, 161, 5.0)] and set(got) == {5, 10, 15, 20, 25, 160}
    assert ann.search(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_copies_and_lengths(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((1500, 8)) * rng.lognormal(0, 1, (1500, 1))
    vectors[500:1000] = vectors[499]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = collect(ann.search(df, F.col("vec_id") % 20 == 0, block=400, query_block=30))
    hits = total = 0
    for q in range(0, 1500, 20):
        want = brute(range(1500), vectors.tolist(), q, 20)
        found = got[q]
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found) and len(found) == 20
        assert all(s == pytest.approx(float(vectors[v] @ vectors[q]), rel=1e-12) for _, v, s in found)
        hits += sum(s >= want[-1][1] for _, _, s in found)
        total += 20
    assert hits / total >= 0.9


def test_all_colliding_vectors_are_verified_in_any_order():
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((3000, 16))
    vectors[:1000] = vectors[0] + 0.02 * rng.standard_normal((1000, 16))
    far = -vectors[0]
    for query in vectors[[3, 1500, 2999]]:
        found = []
        for earlier in ([], [far], [vectors[5], far, vectors[2000]]):
            block = ann.SortedBlock(np.arange(3000), vectors)
            scaled = [np.append(q / np.linalg.norm(q), 0.0) for q in [*earlier, query]]
            for at in scaled:
                candidates = block.candidates(block.lines @ at, 600)
            found.append(candidates.tolist())
        assert found[0] == found[1] == found[2] and len(found[0]) >= 600
        # at the width that was needed, all vectors in enough windows
        extended = np.hstack([vectors / np.linalg.norm(vectors, axis=1).max(), np.zeros((3000, 1))])
        extended[:, -1] = np.sqrt(np.maximum(0, 1 - (extended**2).sum(axis=1)))
        apart = np.sort(np.abs(block.lines @ extended.T - (block.lines @ scaled[-1])[:, None]), axis=0)
        needed = apart[int(np.ceil(ann.COLLIDE_SHARE * ann.PROJECTIONS)) - 1]
        assert found[0] == np.nonzero(needed <= needed[found[0]].max())[0].tolist()


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    got = collect(queries.op3_nearest(spark, sf))
    asked = ids[ids % 20 == 0]
    assert sorted(got) == sorted(asked.tolist())
    hits = 0
    for q in asked.tolist():
        scores = vectors @ vectors[ids == q][0]
        scores[ids == q] = -np.inf
        hits += len({v for _, v, _ in got[q]} & set(ids[np.argsort(-scores)[:20]].tolist()))
    assert hits / (20 * len(asked)) >= 0.9

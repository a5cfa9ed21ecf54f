"""SimHash near-duplicates against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

xxhash = pytest.importorskip("xxhash")

from hirescope.llm import queries, simhash  # noqa: E402
from hirescope.llm.components import connected_components  # noqa: E402


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_labels(ids, prints, radius):
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    labels = np.array(ids)
    while True:
        lower = np.array([labels[row].min() for row in near])
        if (lower == labels).all():
            return labels
        labels = lower


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op10_simhash(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = np.array([brute_print(t) for _, t in docs], np.uint64)
    labels = brute_labels([i for i, _ in docs], prints, 4)
    assert len(got) == len(docs)
    for (i, _), p, label in zip(docs, prints.tolist(), labels.tolist()):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{p:016x}", label)


def test_edge_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(50_000))
    rows = [(9, None, 1), (4, "", 2), (7, " \t\n", 3), (3, "One two", 4), (2, "oNE  two", 5), (1, long, 6), (1, long, 7), (None, "one two", 8), (8, "Éa b c d e", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    got = {(r["doc_id"], r["fingerprint"]): r["representative"]["doc_id"] for r in simhash.near_duplicates(df).collect()}
    assert len(got) == 8 and got[(9, 0)] == got[(4, 0)] == got[(7, 0)] == 4
    signed = lambda t: np.array(brute_print(t), np.uint64).astype(np.int64).item()
    assert got[(3, signed("one two"))] == got[(2, signed("one two"))] == got[(None, signed("one two"))] == 2
    assert got[(1, signed(long))] == 1 and (8, signed("Éa b c d e")) in got
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_tiles_lose_no_link(spark):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(120)]
    prints = set(seeds)
    for s in seeds[:60]:  # chains and dense clouds around the first seeds
        for _ in range(12):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                s ^= 1 << b
            prints.add(s)
    values = np.array(sorted(prints), np.uint64)
    want = brute_labels(range(len(values)), values, 4)
    df = spark.createDataFrame([(int(v),) for v in values.astype(np.int64)], "fingerprint long")
    for tile, sub in ((64, 8), (10_000, 32)):
        found = connected_components(simhash.links(df, 4, tile, sub)).collect()
        roots = {r["node"]: r["root"] for r in found}
        signed = values.astype(np.int64).tolist()
        groups = {}
        for v, label in zip(signed, want.tolist()):
            groups.setdefault(label, set()).add(roots.get(v, v))
        assert all(len(g) == 1 for g in groups.values()) and len({g.pop() for g in groups.values()}) == len(groups)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame([*chain, *star, (5000, 5000)], "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1200)}, 5000: 5000}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0

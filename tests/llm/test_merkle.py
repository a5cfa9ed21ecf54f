"""Merkle manifests against trees of plain Python lists."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest

from hirescope.llm import merkle, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grow(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def way(levels, place):
    steps = []
    for level in levels[:-1]:
        other = place ^ 1
        steps.append((place & 1, level[other] if other < len(level) else ""))
        place >>= 1
    return steps


def fold(node, steps):
    for side, other in steps:
        node = h(other + node if side else node + other)
    return node


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    none_first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    trees = {g: grow([leaf(r) for r in sorted(rs, key=lambda r: (none_first(r[0]), leaf(r)))]) for g, rs in groups.items()}
    order = sorted(trees, key=none_first)
    over = grow([trees[g][-1][0] for g in order])
    out = []
    for g, rs in groups.items():
        for place, r in enumerate(sorted(rs, key=lambda r: (none_first(r[0]), leaf(r)))):
            steps = way(trees[g], place) + way(over, order.index(g))
            tampered = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            root = fold(leaf((*r[:3], r[3] + 1, r[4])) if tampered else leaf(r), steps)
            out.append((r[0], leaf(r), trees[g][-1][0], over[-1][0], h("".join(o for _, o in steps)), root, root == over[-1][0]))
    return sorted(out, key=str)


def reshape(monkeypatch, shape, manifest=merkle.manifest):
    monkeypatch.setattr(merkle, "manifest", lambda *args, **named: manifest(*args, shape=shape, **named))


def ask(spark, df, monkeypatch):
    monkeypatch.setattr(queries, "read_table", lambda *_: df)
    got = queries.op12_merkle(spark, "")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("sf, levels", [("sf0.001", 10), ("sf0.01", 10), ("sf0.01", 2)])
def test_query_against_lists(spark, sf, levels, monkeypatch):
    """With two levels between stored ones, a tree of some hundred leaves is many subtrees on many stored levels."""
    reshape(monkeypatch, merkle.Shape(levels=levels))
    df = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = [tuple(r) for r in df.select(*FIELDS).collect()]
    got = ask(spark, df, monkeypatch)
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(queries.ORACLE["op12_merkle"]).fetchdf()
    got = queries.op12_merkle(spark, sf).toPandas()
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    key = lambda f: f[order].sort_values("doc_id").reset_index(drop=True)
    assert key(got).equals(key(want))


def test_edge_cases(spark, monkeypatch):
    long = "Straße " * 200_000
    rows = [(n, "s", "hot", n * 10, f"t{n}") for n in range(70)]
    rows += [(3, None, None, None, None), (4, "", "", 0, ""), (5, "é", "ö", 1, "é"), (6, "s", "z", 5, long), (6, "s", "z", 5, long), (6, "s", "z", 4, long)]
    rows += [(None, "s", "z", 1, "a"), (None, "s", "z", None, "a"), (7, "s", "=z", 2, "a"), (8, "s", None, 2, "b")]
    df = spark.createDataFrame([(*r, 1, 2, "p") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, idx int, n int, proof string")
    for levels in (1, 3, 10):
        reshape(monkeypatch, merkle.Shape(levels=levels))
        assert ask(spark, df, monkeypatch) == brute(rows)
    one = df.where("lang = 'ö'")
    assert ask(spark, one, monkeypatch) == brute([rows[72]])
    assert ask(spark, df.limit(0), monkeypatch) == []


def test_wider_runs(spark):
    """Four nodes a run: every proof still leads to the root, and no other leaf does."""
    df = spark.range(0, 150).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'a', 'b') AS lang", "CAST(id AS STRING) AS text")
    made = merkle.manifest(df, ["doc_id", "text"], shape=merkle.Shape(4, 2))
    rows = merkle.proofs(made).select("order", "node", "proof").collect()
    assert len(rows) == 150
    for r in rows:
        node, wrong = r["node"], h("x")
        for step in r["proof"]:
            before, after = "".join(step["others"][: step["at"]]), "".join(step["others"][step["at"] :])
            node, wrong = h(before + node + after), h(before + wrong + after)
        assert node == made.root != wrong


def test_only_some_levels_are_stored(spark):
    df = spark.range(0, 300).selectExpr("id AS doc_id", "'a' AS lang", "'' AS text")
    made = merkle.manifest(df, ["doc_id"], shape=merkle.Shape(levels=3))
    assert [level.count() for level in made.groups.levels] == [300, 38, 5, 1]

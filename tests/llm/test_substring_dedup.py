"""Substring deduplication against brute force over all windows."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

pytest.importorskip("xxhash")

from hirescope.llm import queries, substring_dedup as sd  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, k):
    words = [WORD.findall(t or "") for t in texts]
    counts = collections.Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if counts[tuple(w[i : i + k])] > 1:
                gone[i : i + k] = [True] * k
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("chunk_bytes,bucket_hashes", [(1 << 20, 1 << 20), (300, 40)])
def test_small_texts(spark, chunk_bytes, bucket_hashes):
    rng = random.Random(chunk_bytes)
    texts = [None, "", " \t\n\x0b\x0c\r", "a b", "é ü é ü é ü é ü", "a\x1fb c d e\x85f g"] + [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(80)]
    texts += ["same words here in a row"] * 30 + ["x y z " * 3000]
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)] + [(0, None, "n")], "doc_id long, text string, kept string")
    rows = sd.remove_repeats(df, window=4, chunk_bytes=chunk_bytes, bucket_hashes=bucket_hashes).collect()
    assert len(rows) == len(texts) + 1
    got = {r["doc_id"]: r for r in rows}
    for i, want in enumerate(brute(texts, 4)):
        r = got[i]
        assert (r["n_words"], r["n_removed"], r["kept"]) == want
        assert sum(s["end"] - s["start"] for s in r["intervals"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["intervals"], r["intervals"][1:]))


def test_empty_table_and_clash(spark):
    df = spark.createDataFrame([], "doc_id long, text string, kept string")
    assert sd.remove_repeats(df).count() == 0
    with pytest.raises(ValueError):
        sd.remove_repeats(df, columns=["doc_id", "kept"])


def test_hashes_do_not_depend_on_position_or_slices(monkeypatch):
    words = [f"w{i}" for i in range(500)]
    a, b = " ".join(words).encode(), ("x y z " + "\n".join(words)).encode()
    n, plain = sd.Windows(35).hashes(a)
    monkeypatch.setattr(sd, "SLICE", 64)
    m, shifted = sd.Windows(35).hashes(b)
    assert (n, m) == (500, 503) and (plain == shifted[3:]).all() and len(set(plain.tolist())) == len(plain)
    hashes = np.unique(plain)
    assert (sd.unpack(sd.pack(hashes)) == hashes).all()


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op1_substring_dedup(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    for (i, _), (n, removed, kept) in zip(docs, brute([t for _, t in docs], 35)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (n, removed, hashlib.sha256(kept.encode()).hexdigest())

"""Token counts: the separator scan against plain Python and the tokenizer."""

import random

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from hirescope.llm import queries, token_counts as tc  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
SEP = queries.END_OF_TEXT


def brute(ids):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == 9:
            out.append((len(out), start, i - start))
            start = i + 1
    return out + ([(len(out), start, len(ids) - start)] if start < len(ids) else [])


@pytest.mark.parametrize("size,segment", [(1, 3), (4, 2), (50, 1024)])
def test_scan_of_odd_files(spark, size, segment):
    rng = random.Random(size)
    files = {f: [rng.choice([1, 2, 3, 9] if f % 2 else [1, 2] * 9 + [9]) for _ in range(rng.randint(1, 120))] for f in range(12)}
    files |= {20: [9], 21: [9, 9, 9], 22: [1] * 40, 23: [9] + [1] * 30, 24: [1] * 30 + [9]}
    rows = [(f, i // size, np.array(x[i : i + size], "<u2").tobytes(), "n") for f, x in files.items() for i in range(0, len(x), size)]
    rows += [(22, 500, None, "n"), (22, 501, b"", "n"), (30, 0, None, "n")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(f, b, bytearray(d) if d is not None else None, n) for f, b, d, n in rows], "file long, block long, data binary, n string")
    got = {}
    for r in tc.count_tokens(df, 9, segment=segment).collect():
        got.setdefault(r["file"], []).append((r["doc"], r["start"], r["n_tokens"]))
    assert {f: sorted(x) for f, x in got.items()} == {f: brute(x) for f, x in files.items()}
    assert tc.count_tokens(df.limit(0), 9).count() == 0


def test_flat_files(spark, tmp_path):
    rng, files = random.Random(3), {}
    for name in ("a.bin", "b.bin", "empty.bin"):
        files[name] = [] if name[0] == "e" else [rng.choice([1, 2, 3, 4, 9]) for _ in range(500)]
        (tmp_path / name).write_bytes(np.array(files[name], "<u2").tobytes())
    got = {}
    for r in tc.count_tokens(tc.read_token_files(spark, str(tmp_path), 16), 9, segment=4).collect():
        got.setdefault(r["file"].rsplit("/")[-1], []).append((r["doc"], r["start"], r["n_tokens"]))
    assert {f: sorted(x) for f, x in got.items()} == {f: brute(x) for f, x in files.items() if x}


def test_files_are_read_in_ranges(spark, tmp_path, monkeypatch):
    """No file is held whole: the binary reader's own limit does not count, and one file has many tasks."""
    monkeypatch.setattr(tc, "RANGE", 2)
    rng, files = random.Random(4), {}
    for name, n in (("one.bin", 5000), ("a b%20c.bin", 33), ("empty.bin", 0)):
        files[name] = [rng.choice([1, 2, 3, 4, 9]) for _ in range(n)]
        (tmp_path / name).write_bytes(np.array(files[name], "<u2").tobytes())
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 100)
    try:
        blocks = tc.read_token_files(spark, str(tmp_path), 16)
        rows = blocks.collect()
        assert blocks.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    got = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["block"])):
        got.setdefault(r["file"].rsplit("/")[-1], []).append((r["block"], bytes(r["data"])))
    for name, ids in files.items():
        data = np.array(ids, "<u2").tobytes()
        assert got.get(name, []) == [(i, data[32 * i : 32 * i + 32]) for i in range(-(-len(data) // 32))]


def test_documents_of_any_length(spark):
    texts = [None, "", "a b c", "word " * 3000, "<|endoftext|> x", "a b c"]
    df = spark.createDataFrame([(i % 5, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, docs int").coalesce(2)
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    blocks = tc.token_blocks(df, PATH, SEP, block_tokens=100)
    rows = sorted((r["doc_id"], r["n_tokens"]) for r in tc.count_tokens(blocks, SEP, "doc_id", segment=3).collect())
    assert rows == sorted((i % 5, len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in enumerate(texts))
    assert tc.count_tokens(tc.token_blocks(df.limit(0), PATH, SEP), SEP, "doc_id").count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((r["doc_id"], r["n_tokens"]) for r in queries.op9_token_counts(spark, sf).collect())
    assert got == sorted((i, len(t.encode(x, add_special_tokens=False).ids)) for i, x in docs)

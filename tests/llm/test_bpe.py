"""Byte-level BPE against the tiktoken library and exact round trips."""

import base64
import hashlib
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

from hirescope.llm import bpe, queries  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def both(spark, rows, schema="doc_id long, text string"):
    ids = bpe.encode(spark.createDataFrame(rows, schema), PATH, public_tokenizers.PATTERN)
    return {r["doc_id"]: (list(r["ids"]), bytes(r["decoded"])) for r in bpe.decode(ids, PATH).collect()}


def test_edge_cases(spark, reference):
    rng = random.Random(3)
    alphabet = "a b\t\n \x1c\x1d\x85 é1²'sS½.!　​\U0001f600́ǅ<|endoftext|>"
    texts = ["", " ", "  \n ", "<|endoftext|>", "don't  stop", "x" * 5000, "word " * 20000, "  end "]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    got = both(spark, [(i, t) for i, t in enumerate(texts)] + [(10_000, None)])
    for i, text in enumerate(texts):
        assert got[i] == (reference.encode_ordinary(text), text.encode()), repr(text)
    assert got[10_000] == ([], b"")


def test_every_token_is_reachable():
    ranks = bpe.read_ranks(PATH)
    enc = bpe.Encoder(bpe.sentencepiece_model(ranks), public_tokenizers.PATTERN)
    model = enc._model
    mapped = ["".join(chr(bpe.BYTE_BASE + b) for b in token) for token in ranks]
    assert model.encode(mapped) == [[rank] for rank in ranks.values()]


def test_repeated_rows_extra_columns_and_empty_table(spark):
    rows = [(1, "same text", "x", 5), (1, "same text", "y", None)]
    schema = "doc_id long, text string, ids string, decoded int"
    df = spark.createDataFrame(rows, schema)
    ids = bpe.encode(df, PATH, public_tokenizers.PATTERN)
    assert ids.columns == ["doc_id", "ids"] and ids.distinct().count() == 1 and ids.count() == 2
    assert bpe.decode(bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_vocabulary_with_gaps_is_refused():
    with pytest.raises(ValueError):
        bpe.sentencepiece_model({b"a": 0, b"b": 2})


def test_query(spark, reference):
    from hirescope.llm.common import read_table

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op8_byte_bpe(spark, sf).collect()}
    rows = read_table(spark, sf, "documents").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids = reference.encode_ordinary(text)
        r = got[doc_id]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_patterns_that_reach_across_white_space_are_refused():
    bpe.check_pattern(public_tokenizers.PATTERN)
    for pattern in (r"\w+\s+\w+|\s|\S", r"[^\n]+|\n", r"\s+|\S+(?=\s)|\S"):
        with pytest.raises(ValueError, match="white space"):
            bpe.check_pattern(pattern)

"""The corpus pipeline: every stage against brute force on its own input."""

import collections
import math
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
public_tokenizers = pytest.importorskip("public_tokenizers")
pytest.importorskip("xxhash")
tokenizers = pytest.importorskip("tokenizers")

import test_packing  # noqa: E402
import test_pii  # noqa: E402
import test_quality  # noqa: E402
import test_simhash  # noqa: E402
import test_substring_dedup  # noqa: E402

import corpus_pipeline as cp  # noqa: E402
from hirescope.llm.common import materialize  # noqa: E402

SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.select(*cp.COLUMNS).collect()]


def test_stages(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    docs, out = given, {}
    for name, stage in cp.STAGES:
        before = docs
        docs = materialize(stage(spark, before, SF), f"test-{name}")
        out[name] = (before, docs)
    for name in list(out)[:-1]:
        assert out[name][1].columns == given.columns

    # quality rules: what stays is unchanged and passes the base rules; labelled good documents stay, bad ones go
    before, after = map(rows, out["quality_rules"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r[0] for r in after}
    assert set(after) < set(before) and all(not test_quality.brute(r[1])[1] for r in after)
    rest = [r for r in before if not test_quality.brute(r[1])[1] and r[0] in labels]
    assert np.mean([r[0] in kept for r in rest if labels[r[0]] == 1]) > 0.97

    before, after = map(rows, out["simhash_near_dedup"])
    prints = np.array([test_simhash.brute_print(r[1]) for r in before], np.uint64)
    stay = test_simhash.brute_labels([r[0] for r in before], prints, 4)
    assert sorted(after) == sorted(r for r, label in zip(before, stay.tolist()) if r[0] == label)

    before, after = map(rows, out["substring_dedup"])
    want = [(i, text if not removed else left, lang, source, len(text if not removed else left)) for (i, text, lang, source, _), (_, removed, left) in zip(before, test_substring_dedup.brute([r[1] for r in before], 35))]
    assert sorted(after) == sorted(want)

    before, after = map(rows, out["pii"])
    want = []
    for i, text, lang, source, _ in before:
        new, at = "", 0
        for start, end, kind in sorted((s, e, k) for k, s, e in test_pii.brute(text)):
            new, at = (new + text[at:start] + f"[{kind.upper()}]", end) if start >= at else (new, max(at, end))
        want.append((i, new + text[at:], lang, source, len(new + text[at:])))
    assert sorted(after) == sorted(want)

    before, after = out["best_fit_packing"]
    t = tokenizers.Tokenizer.from_file(test_packing.PATH)
    t.encode_special_tokens = True
    expected = test_packing.want(lambda x: t.encode(x, add_special_tokens=False).ids + [0], [(r[0], r[1]) for r in rows(before)], 2048)
    found = after.collect()
    assert test_packing.check(found, expected, 2048) <= math.ceil(1.02 * sum(r["length"] for r in found) / 2048) + 1


def edge(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (2, text + " tail", "en", None, None), (None, None, None, None, None), (3, "", "en", "s", 0), (None, " ".join(f"other{i} a@b.co" for i in range(40)), "x", "y", 1)]
    return spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string")


def test_every_stage_on_odd_rows(spark):
    docs = edge(spark)
    counts = collections.Counter()
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF).collect()
        counts[name] = len(out)
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name == "pii":
            assert sum("[EMAIL]" in (r["text"] or "") for r in out) == 1
    counts.pop("simhash_near_dedup")  # depends on how near the two long texts are
    assert counts == {"quality_rules": 4, "substring_dedup": 6, "pii": 6, "best_fit_packing": 6}
    near = cp.simhash_near_dedup(spark, docs, SF).collect()
    assert sum(r["doc_id"] == 1 for r in near) == 1 and sum(not r["text"] for r in near) == 1


def test_run(spark):
    out = cp.run(spark, SF)
    assert out.columns[-2:] == ["sequence_id", "offset"] and out.count() > 0

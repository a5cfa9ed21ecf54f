"""Quality rules: statistics against plain Python, learned lists against planted rules."""

import collections
import random
import re

from pyspark.sql import functions as F

from hirescope.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = collections.Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered.update(range(i, i + 5))
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)), n < 10 or 100 * len(covered) > 20 * n


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics(spark):
    rng = random.Random(4)
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", "a b c d e", "a a a a a a", "x\n\n \nx\nx y\n", "é\x85ü\x1fö <|#|>", "\U0001f600 b", "a b c d e f " * 4000]
    texts += [" ".join(rng.choice("abc\n") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    texts += ["".join(rng.choice("ab #$\n\t ") for _ in range(rng.randint(0, 60))) for _ in range(150)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in quality.with_statistics(df, ["doc_id"]).select("doc_id", "__stats", quality.base_failed(F.col("__stats")).alias("f")).collect():
        assert (tuple(r["__stats"][c] for c in NAMES), r["f"]) == brute(texts[r["doc_id"]]), repr(texts[r["doc_id"]])


def test_learns_planted_conjunction(spark):
    rng, rows = random.Random(7), []
    for i in range(3000):
        v = {f: rng.random() for f in quality.FEATURES}
        rows.append((i, (v["symbols_per_word"] > 0.7 and v["distinct_share"] <= 0.4) or v["mean_word_chars"] > 0.95, *v.values()))
    df = spark.createDataFrame(rows, "doc_id long, bad boolean, " + ", ".join(f"{f} double" for f in quality.FEATURES))
    rules = quality.learn(df)
    hit = quality._holds(rules[0], df)
    for rule in rules[1:]:
        hit = hit | quality._holds(rule, df)
    right = df.where(hit == F.col("bad")).count() / len(rows)
    assert 1 <= len(rules) <= quality.MAX_RULES and right > 0.95, rules


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "k"), (1, None, "k"), (2, "one two " * 3, "k"), (None, " ".join(f"w{i}" for i in range(20)), "k")], "doc_id long, text string, kept string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    odd = spark.createDataFrame([(1, None), (7, 0), (2, 0), (2, 0), (2, 1)], "doc_id long, quality int")
    for labels in (none, odd):
        got = sorted((r["doc_id"] or 0, r["base_failed"], r["kept"]) for r in quality.judge(docs, labels).collect())
        assert got == [(0, False, True), (1, True, False), (1, True, False), (2, True, False)]
    assert quality.judge(docs.limit(0), odd).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    df = queries.op5_quality_rules(spark, sf)
    assert not any(word in df._jdf.queryExecution().toString() for word in ("Python", "Pandas", "Arrow"))
    rows = df.collect()
    assert len(rows) == len(docs)
    right = wrong = 0
    for r in rows:
        base, failed = brute(docs[r["doc_id"]])
        assert (tuple(r[c] for c in NAMES), r["base_failed"]) == (base, failed) and not (failed and r["kept"])
        if not failed and r["doc_id"] in labels:
            right += r["kept"] == (labels[r["doc_id"]] == 1)
            wrong += r["kept"] != (labels[r["doc_id"]] == 1)
    assert right / (right + wrong) > 0.97


def covering(rows):
    """Sequential covering over plain lists: (id, bad, values) to rejecting rules."""
    import math
    import struct

    import xxhash

    signed = lambda h: h - (1 << 64) if h >> 63 else h
    prunes = lambda i: signed(xxhash.xxh64_intdigest(struct.pack("<q", i), 42)) % quality.PRUNE_EVERY == 0
    holds = lambda tests, v: all(v[f] > t if sign == ">" else v[f] <= t for f, sign, t in tests)
    cuts = {f: set() for f in quality.FEATURES}
    for side in (True, False):
        for f in quality.FEATURES:
            own = sorted(v[f] for _, bad, v in rows if bad == side)
            cuts[f] |= {own[max(1, math.ceil(len(own) * i / quality.THRESHOLDS)) - 1] for i in range(1, quality.THRESHOLDS)}
    rules = []
    while len(rules) < quality.MAX_RULES:
        left = [r for r in rows if not any(holds(rule, r[2]) for rule in rules)]
        grown, tests = [r for r in left if not prunes(r[0])], []
        while len(tests) < quality.MAX_TESTS:
            inside = [r for r in grown if holds(tests, r[2])]
            p = sum(bad for _, bad, _ in inside)
            if not p or p == len(inside):
                break
            best, chosen = 0.0, None
            for f in quality.FEATURES:
                for t in sorted(cuts[f]):
                    for sign in ("<=", ">"):
                        covered = [bad for _, bad, v in inside if holds([(f, sign, t)], v)]
                        if sum(covered):
                            gain = sum(covered) * (math.log2(sum(covered) / len(covered)) - math.log2(p / len(inside)))
                            if gain > best + 1e-9:
                                best, chosen = gain, (f, sign, t)
            if chosen is None:
                break
            tests.append(chosen)
        pruning, ranked = [r for r in left if prunes(r[0])], []
        for n in range(1, len(tests) + 1):
            covered = [bad for _, bad, v in pruning if holds(tests[:n], v)]
            ranked.append(((2 * sum(covered) - len(covered)) / max(1, len(covered)), -n, sum(covered), len(covered)))
        if not ranked:
            break
        _, n, good, total = max(ranked)
        if good < quality.MIN_SUPPORT or good < quality.MIN_PRECISION * total:
            break
        rules.append(tests[:-n])
    return rules


def test_learned_list_equals_plain_covering(spark):
    for seed in (1, 2):
        rng, rows = random.Random(seed), []
        for i in range(1200):
            v = {f: rng.randint(0, 12) / 8 for f in quality.FEATURES}
            bad = (v["symbols_per_word"] > 1.0 and v["distinct_share"] <= 0.5) or v["mean_word_chars"] > 1.4 or rng.random() < 0.02
            rows.append((i, bad, v))
        df = spark.createDataFrame([(i, bad, *v.values()) for i, bad, v in rows], "doc_id long, bad boolean, " + ", ".join(f"{f} double" for f in quality.FEATURES))
        want = covering(rows)
        assert quality.learn(df) == want and len(want) >= 1

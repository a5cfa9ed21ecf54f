"""Personal data: base spans against Python's re, planted contexts, redaction."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from hirescope.llm import pii, queries

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, m):
    digits = [int(c) for c in m if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits[::-1])) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def tuples(spans):
    return [(s["kind"], s["start"], s["end"]) for s in spans]


def card(rng):
    digits = [rng.randint(0, 9) for _ in range(15)]
    total = sum(d if i % 2 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits[::-1]))
    return "".join(map(str, [*digits, -total % 10]))


def test_base_spans(spark):
    rng = random.Random(11)
    alphabet = [*"ab.@+-_%() 0123456789\n", "a@b.c", "1.2.3.4", "+1 (555) 123-4567", "\U0001f600", "é", "255.", "256.", "4111 1111 1111 1111"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    texts += [None, "", "a@b.c_d@e.f", "1.2..3.4.5.6.7.8.9", "001.002.0255.4 1.2.3.99999999999999999999", "+1" + "(" * 3000, "9" * 30_000, "a" * 30_000, "a" * 20_000 + "@b" + ".c" * 20_000, "1 " * 20_000]
    texts += [f"x {card(rng)}, " * rng.randint(1, 700) for _ in range(5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    spans = F.concat(*(pii.base_spans(F.coalesce("text", F.lit("")), k) for k in pii.KINDS))
    for i, found in df.select("doc_id", spans).collect():
        assert tuples(found) == brute(texts[i]), repr(texts[i])[:200]


def planted(rng):
    """Employee numbers after the words that introduce known phones; plain numbers elsewhere."""
    docs = []
    for i in range(60):
        docs.append(f"please call desk: +1 (555) 01{i:02d}-{1000 + i} before noon")
    for i in range(6):
        docs.append(f"or please call desk: ext-77{i}41 today")
    for i in range(40):
        docs.append(f"the total of 8{i}55{i} units, section {i}.4.{i}2 was sold")
    return docs


def test_bootstrap_discovers_unseen_identifiers(spark):
    docs = planted(random.Random(1))
    df = spark.createDataFrame([*enumerate(docs), (3, docs[3])], "doc_id long, text string")
    rows = pii.find(df).collect()
    assert len(rows) == len(docs) + 1
    for r in rows:
        text, base, spans = docs[r["doc_id"]], tuples(r["base"]), tuples(r["spans"])
        assert base == brute(text)
        extra = [text[s:e] for k, s, e in spans if (k, s, e) not in base]
        assert extra == ([re.search(r"ext-\w+", text)[0]] if "ext-" in text else [])
        assert all(k == "phone" for k, _, _ in spans)


def test_redact(spark):
    text = "mail a@b.co or call +1 (555) 123-4567. " * 500
    rows = [(1, text), (2, None), (3, "none"), (4, "card 4111 1111 1111 1111 end"), (5, "\U0001f600" * 5000 + " x@y.zz \U0001f600")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = F.concat(*(pii.base_spans(F.coalesce("text", F.lit("")), k) for k in pii.KINDS))
    got = {r[0]: r[1] for r in df.select("doc_id", pii.redact(F.col("text"), spans)).collect()}
    assert got[1] == "mail [EMAIL] or call [PHONE]. " * 500 and got[2] is None and got[3] == "none"
    assert got[4] == "card [CARD] end" and got[5] == "\U0001f600" * 5000 + " [EMAIL] \U0001f600"
    over = [("a", 2, 9), ("b", 4, 6), ("c", 8, 12)]
    df = spark.createDataFrame([("0123456789abcdef", over)], f"text string, spans {pii.SPANS}")
    assert df.select(pii.redact(F.col("text"), F.col("spans"))).first()[0] == "01[A]cdef"


def test_edge_cases(spark):
    df = spark.createDataFrame([(None, None, "a"), (None, "x@y.zz", "a"), (1, "", "b")], "doc_id long, text string, spans string")
    got = sorted((r["doc_id"] or 0, tuples(r["spans"])) for r in pii.find(df).collect())
    assert got == [(0, []), (0, [("email", 0, 6)]), (1, [])]
    assert pii.find(df.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    df = queries.op2_pii(spark, sf)
    assert not any(word in df._jdf.queryExecution().toString() for word in ("Python", "Pandas", "Arrow"))
    rows = df.collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = brute(docs[r["doc_id"]])
        line = [f"{k}:{s}:{e}" for k, s, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(line).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        assert set(line) <= set(r["spans"].split(",") if r["spans"] else [])


def test_instances_are_whole_tokens(spark):
    cards = "4111 1111 1111 1111", "4012888888881881"
    cases = {
        "see the 48F29-AA now": ["48f29-aa"],
        "see the 12AB34567, now": ["12ab34567"],
        "see the 2019-AB-7781 now": ["2019-ab-7781"],
        "see the 77041-X and the 77041-Y now": ["77041-x", "77041-y"],
        "see the (77041) now": ["77041"],
        "see the 192.168.0.17. now": ["192.168.0.17"],
        "see the +12AB345 now": ["+12ab345"],
        "call the +1 (555) 010-1000, then the 77041-1 2": ["+1 (555) 010-1000", "77041-1 2"],
        "call the +1 (555) 010-1000x5 now": ["+1 (555) 010-1000x5"],
        f"pay the {cards[0]} now": [cards[0]],
        f"pay the {cards[0]}x now": [f"{cards[0]}x"],
        f"pay the {cards[1]}-AA now": [f"{cards[1]}-aa"],
        "see the 48joe@x.com now": ["48joe@x.com"],
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {i: x for i, x in df.select("doc_id", pii.instances(F.col("text"))).collect()}
    for i, (text, want) in enumerate(cases.items()):
        assert [x["instance"] for x in got[i]] == want, text
        assert [text[x["start"] : x["end"]].lower() for x in got[i]] == want
    # what follows an entity inside a list is seen too, and long runs cost no more than one pass
    lists = [f"+1 (555) 010-1000,+1 (555) 010-1001;{cards[0]},{cards[1]}|77041-X", "+1 (555) 010-1000 77041AB 2 " + cards[0] + " 77041AB"]
    lists += ["9" * 30_000 + "x", "+1" + "9" * 30_000 + "x", "1 " * 20_000 + "x1", "1-" * 20_000, "+1" + "(1" * 20_000, "a" * 30_000 + "1"]
    df = spark.createDataFrame(list(enumerate(lists)), "doc_id long, text string")
    found = {i: x for i, x in df.select("doc_id", F.transform(F.regexp_extract_all("text", F.lit(pii.INSTANCE), F.lit(0)), lambda m: F.btrim(m, F.lit(pii.EDGES)))).collect()}
    assert found[0] == ["+1 (555) 010-1000", "+1 (555) 010-1001", *cards, "77041-X"]
    assert found[1] == ["+1 (555) 010-1000", "77041AB", "2 " + cards[0], "77041AB"]
    assert found[2] == [lists[2]] and found[3] == [lists[3]] and found[7] == [lists[7]]


def test_bootstrap_discovers_digit_first_identifiers(spark):
    docs = planted(random.Random(1)) + [f"or please call desk: {i}8F29-{i}A today" for i in range(6)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    for r in pii.find(df).collect():
        text, base = docs[r["doc_id"]], tuples(r["base"])
        extra = [text[s:e] for k, s, e in tuples(r["spans"]) if (k, s, e) not in base]
        assert extra == re.findall(r"ext-\w+|\w+-\wA", text)


def test_context_is_two_words_whatever_they_are(spark):
    far = "word" * 1000
    cases = {
        "tel desk +1 (555) 010-1000 ext 77041": [("+1 (555) 010-1000", "tel desk"), ("77041", "+0 ext")],
        "room 4 ext-77041": [("ext-77041", "room 0")],
        "Phone:  +1 (555) 010-1000\n77041-X\t48F29-AA": [("+1 (555) 010-1000", "phone:"), ("77041-x", "phone: +0"), ("48f29-aa", "+0 0-x")],
        "77041-X 48F29-AA": [("48f29-aa", "0-x")],
        "mail (joe@x.com), ext 77041": [("joe@x.com", "mail ("), ("77041", "@ ext")],
        "a call" + " " * 5000 + "77041": [("77041", "a call")],
        f"a {far} {far} 77041": [("77041", hashlib.sha256(f"{far} {far}".encode()).hexdigest())],
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {i: x for i, x in df.select("doc_id", pii.instances(F.col("text"))).collect()}
    for i, want in enumerate(cases.values()):
        assert [(x["instance"], x["pattern"]) for x in got[i]] == want


def test_bootstrap_in_contact_blocks(spark):
    docs = [f"room {i} +1 (555) 01{i:02d}-{1000 + i}" for i in range(12)] + [f"room {i} ext-77{i}41" for i in range(3)] + [f"sold {i} of-88{i}41" for i in range(3)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    extra = {r["doc_id"]: [docs[r["doc_id"]][s:e] for k, s, e in tuples(r["spans"]) if (k, s, e) not in tuples(r["base"])] for r in pii.find(df).collect()}
    assert extra == {i: re.findall(r"ext-\w+", text) for i, text in enumerate(docs)}


def test_bootstrap_follows_links_of_any_length(spark):
    # every pattern but the first needs the instance that the one before it finds
    rows = [("p 0", f"s{j}", "phone") for j in range(5)] + [("p 0", "x1", None)]
    for n in range(1, 6):
        rows += [(f"p {n}", f"s{j}", "phone") for j in range(4)] + [(f"p {n}", f"x{n}", None), (f"p {n}", f"x{n + 1}", None)]
    edges = spark.createDataFrame(rows, "pattern string, instance string, seed string")
    patterns, known = pii.bootstrap(edges)
    assert sorted(r["pattern"] for r in patterns.collect()) == [f"p {n}" for n in range(6)]
    assert sorted(r["instance"] for r in known.where("confidence < 1").collect()) == [f"x{n}" for n in range(1, 7)]
    with pytest.raises(RuntimeError):
        pii.bootstrap(edges, rounds=2)


def plain_bootstrap(edges):
    """(pattern, instance, seed) to accepted patterns and instances, on dictionaries."""
    import math
    from collections import defaultdict

    seeds = {}
    for _, i, s in edges:
        if s is not None:
            seeds[i] = min(s, seeds.get(i, s))
    known = {i: (k, 1.0) for i, k in seeds.items()}
    while True:
        by_pattern = defaultdict(list)
        for p, i, _ in edges:
            by_pattern[p].append(known.get(i))
        patterns = {}
        for p, found in by_pattern.items():
            rated = []
            for k in pii.KINDS:
                own = [c for kind, c in filter(None, found) if kind == k]
                rated.append((sum(own) / len(found), len(own), k))
            score, support, kind = max(rated)
            if score >= pii.MIN_SCORE and support >= pii.MIN_SUPPORT:
                patterns[p] = kind, score
        doubts = defaultdict(float)
        for p, i, s in edges:
            if s is None and p in patterns:
                doubts[i, patterns[p][0]] += math.log(1 - min(patterns[p][1], 0.999))
        now = {i: (k, 1.0) for i, k in seeds.items()}
        for (i, k), d in sorted(doubts.items(), key=lambda x: (-x[1], x[0][1])):
            if i not in seeds and 1 - math.exp(d) >= pii.MIN_CONFIDENCE:
                now[i] = k, 1 - math.exp(d)  # the last one is the most confident
        settled = {i: (k, round(c, 6)) for i, (k, c) in now.items()} == {i: (k, round(c, 6)) for i, (k, c) in known.items()}
        known = now
        if settled:
            return patterns, known


def test_bootstrap_equals_plain_rounds(spark):
    """Random graphs in which a few contexts hold mostly one kind, so that instances are found over several steps."""
    sizes = []
    for seed in range(3):
        rng, edges = random.Random(seed), {}
        for p in range(40):
            group = p // 10
            told, untold = [i for i in range(60) if i % 3], [i for i in range(60) if not i % 3]
            n = rng.choice([1, 2, 2, 3, 6])
            for i in rng.sample(told, 11) + rng.sample(untold, n):
                kind = pii.KINDS[group] if rng.random() < 0.97 else rng.choice(pii.KINDS)
                edges[f"c{p}", f"i{group}-{i}"] = kind if i % 3 and p % 10 < 7 else None
        rows = [(p, i, s) for (p, i), s in edges.items()]
        patterns, known = pii.bootstrap(spark.createDataFrame(rows, "pattern string, instance string, seed string"))
        want_patterns, want_known = plain_bootstrap(rows)
        assert {r["pattern"]: (r["kind"], round(r["score"], 9)) for r in patterns.collect()} == {p: (k, round(s, 9)) for p, (k, s) in want_patterns.items()}
        assert {r["instance"]: (r["kind"], round(r["confidence"], 9)) for r in known.collect()} == {i: (k, round(c, 9)) for i, (k, c) in want_known.items()}
        sizes.append((len(want_patterns), sum(c < 1 for _, c in want_known.values())))
    assert all(n for n, _ in sizes) and any(m for _, m in sizes)

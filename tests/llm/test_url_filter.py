"""URL filter: rules and models against plain Python."""

import collections
import math
import random
import re

import pytest

from pyspark.sql import functions as F

from hirescope.llm import queries, url_filter as uf


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def ruled(host, path):
    fit = []
    for verdict, pattern in uf.RULES:
        h, rest = pattern.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + rest):
            fit.append((len(pattern), pattern, verdict))
    return max(fit)[1:] if fit else (None, None)


def numbers(text):
    plain = re.sub("[^0a-z/._-]", " ", re.sub("[0-9]", "0", text.lower()))
    return [("abcdefghijklmnopqrstuvwxyz" + "/._-" + "0 ").index(c) for c in f"  {plain} "]


def model(texts):
    seen = collections.defaultdict(collections.Counter)
    for t in texts:
        x = numbers(t)
        for i in range(2, len(x)):
            for k in range(3):
                seen[tuple(x[i - k : i])][x[i]] += 1

    def p(context, c):
        shorter = p(context[1:], c) if context else 1 / 32
        own = seen.get(context)
        return (own[c] + len(own) * shorter) / (sum(own.values()) + len(own)) if own else shorter

    return p


def score(text, accepted, rejected):
    x = numbers(text)
    return sum(math.log(accepted(tuple(x[i - 2 : i]), x[i]) / rejected(tuple(x[i - 2 : i]), x[i])) for i in range(2, len(x))) / (len(x) - 2)


ODD = [None, "", "nothing", "://", "http://", "HTTP://WWW.Example.COM/en/1", "x://a://b.com/en/", "http://com", "http://com/", "http://notexample.com/en/", "http://a.example.com/en?x=/en/", "http://example.net/es/#a", "http://net/es/", "http://\u00c9.net/fr/\U0001f600", "http://a.com\n/x", "http://b.org/" + "y" * 5000]


def test_rules(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "page_id long, url string")
    rows = {r["page_id"]: r for r in uf.judge(df).collect()}
    assert len(rows) == len(ODD)
    for i, url in enumerate(ODD):
        host, path = parse(url)
        rule, verdict = ruled(host, path)
        r = rows[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")


def test_scores_against_plain_models(spark):
    rng = random.Random(2)
    urls = [f"http://{rng.choice(['www', 'm', 'blog'])}.{rng.choice(['good', 'fine'])}.com/de/{rng.randint(0, 99)}" for _ in range(60)]
    urls += [f"http://spam{rng.randint(0, 9)}.example.com/en/casino-{rng.randint(0, 99)}.html" for _ in range(60)]
    urls += ["http://casino.org/spam", "http://good.org/de/7", "http://zzz.org/\u00fc"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    held = {r["t"]: r["h"] for r in df.select(F.concat(*uf.host_path(F.col("url"))).alias("t"), (F.pmod(F.xxhash64(*uf.host_path(F.col("url"))), F.lit(uf.CALIBRATE_EVERY)) == 0).alias("h")).collect()}
    sides = {"allow": [], "block": []}
    for u in urls:
        text, (rule, verdict) = "".join(parse(u)), ruled(*parse(u))
        if rule and not held[text]:
            sides[verdict].append(text)
    accepted, rejected = model(sides["allow"]), model(sides["block"])
    rows = {r["page_id"]: r for r in uf.judge(df).collect()}
    for i, u in enumerate(urls):
        if rows[i]["rule"] is None:
            assert rows[i]["score"] == pytest.approx(score("".join(parse(u)), accepted, rejected), abs=1e-5)
        else:
            assert rows[i]["score"] is None
    assert rows[len(urls) - 3]["verdict"] == "block" and rows[len(urls) - 2]["verdict"] == "allow"


def test_edge_cases(spark):
    df = spark.createDataFrame([(1, "http://a.org/x", "h", "r"), (1, "http://a.org/x", "h", "r"), (None, None, None, None)], "page_id long, url string, host string, rule string")
    rows = uf.judge(df).collect()
    assert len(rows) == 3 and all(r["verdict"] == "allow" and r["score"] == 0.0 for r in rows)
    assert uf.judge(df.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    df = queries.op7_url_filter(spark, sf)
    assert not any(word in df._jdf.queryExecution().toString() for word in ("Python", "Pandas", "Arrow"))
    rows = df.collect()
    assert len(rows) == len(pages) and {r["verdict"] for r in rows} == {"allow", "block"}
    for r in rows:
        host, path = parse(pages[r["page_id"]])
        rule, verdict = ruled(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and (rule is None or r["verdict"] == verdict)

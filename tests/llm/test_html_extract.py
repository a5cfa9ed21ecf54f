"""Main text of pages: parser cases, exact alignment, differencing against brute force."""

import html
import random
import re

import pytest

from hirescope.llm import html_extract as he, queries


def texts(page, *zones):
    return [t for t, z in he.page_lines(page) if z in (zones or (he.ARTICLE,))]


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


@pytest.mark.parametrize("table_bits", [1 << 27, 6])
def test_alignment_is_a_longest_common_subsequence(monkeypatch, table_bits):
    monkeypatch.setattr(he, "TABLE_BITS", table_bits)
    rng = random.Random(table_bits)
    for _ in range(1500):
        a, b = ([rng.randint(0, rng.choice([2, 5])) for _ in range(rng.randint(0, 12))] for _ in range(2))
        at = he.common_lines(a, b)
        assert at == sorted(set(at)) and len(at) == lcs_length(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in at)


def test_zones():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p><article>";</script></head>
    <body class="sidebar-left"><header>Site</header><nav><ul><li><a href="/">Home</a></ul></nav><div class="ad-box">Buy</div>
    <aside>Side</aside><form>Name <input> <button>Go</button></form><div id="cookie-notice">We use</div><!-- <p>no</p> -->
    <article><header><h1>Head &amp; shoulders</h1></header><p><b>One<br>line&nbsp;two<p>Second &lt;p&gt; &eacute;<div class="related"><p>See</div>
    <table><tr><td>c1<td>c2</table><ul><li>i1<li>i2</ul><footer>by me</footer><section class="comments"><p>First!</section><p title='a > b'>last</article>
    <footer>&copy; me</footer>"""
    assert texts(page) == ["Head & shoulders", "One line two", "Second <p> é", "c1", "c2", "i1", "i2", "last"]
    assert texts(page, he.OPEN) == []


def test_odd_pages():
    assert he.page_lines(None) == he.page_lines("") == he.page_lines("<p> \n </p>") == []
    assert texts("plain &lt;text", he.OPEN) == ["plain <text"]
    assert texts("<p>a < b and c > d</p><p>x", he.OPEN) == ["a < b and c > d", "x"]
    assert texts("<p class='x>unclosed quote</p><p>y</p>", he.OPEN)[-1] == "y"
    assert texts("<script>never closed <p>x</p>", he.OPEN) == []
    assert texts("</div></p>stray<!-- open comment <p>z", he.OPEN) == ["stray"]
    assert len(texts("<div>" * 3000 + "deep" + "</div>" * 3000, he.OPEN)) == 1
    assert texts('<div role="main"><p>m</p></div><p>o</p>') == ["m"]
    assert texts('<main class="comments-enabled"><p>m</p></main>') == ["m"]


def test_classes_of_text_elements_delete_nothing_from_an_article():
    page = """<article><p>a</p><p class="alert">b</p><ul><li class="search">c</li></ul><blockquote class="share">d <span class="ad">e</span></blockquote>
    <div class="related"><p>gone</p></div><h2 id="comments">f</h2></article><p class="alert">out</p>"""
    assert texts(page) == ["a", "b", "c", "d e", "f"]


def test_quoted_values_hold_anything():
    assert texts("""<p title='a > b' data-x="<b>x</b>">y</p><p title="it's">z</p>""", he.OPEN) == ["y", "z"]


@pytest.mark.parametrize("piece", ["<a ", '<a "', '<a ">"', "<", "</", "<a '\"", '<a "<b>" ', "<!x ", "<p><", '<a b="c" <', "&lt", "<div>", "<p>x"])
def test_broken_markup_takes_linear_time(piece):
    import time

    seconds = []
    for size in (125_000, 1_000_000):
        start = time.process_time()
        he.page_lines(piece * (size // len(piece)))
        seconds.append(time.process_time() - start)
    assert seconds[1] < 30 * max(seconds[0], 0.05)


def plain_page(lines):
    return "<html><body>" + "".join(f"<div>{html.escape(x)}</div>" for x in lines) + "</body></html>"


def test_differencing_of_unmarked_pages(spark):
    rng, rows, want = random.Random(6), [], {}
    for host in range(4):
        pages = []
        for i in range(rng.choice([1, 12, 30])):
            body = [f"h{host} p{i} line {k}" for k in range(rng.randint(0, 5))]
            lines = [f"menu {host}", "start", *body[:2], f"ad {rng.randint(0, 2)}", *body[2:], f"foot {host}"]
            pages.append((f"/{rng.randint(0, 3)}/{i:03d}", lines))
        pages.append(pages[0])  # a copy under the same path
        for path, lines in pages:
            want[len(rows)] = (host, path, lines)
            rows.append((len(rows), f"http://h{host}.org{path}?q=1", plain_page(lines), "t"))
    rows += [(900, None, plain_page(["a", "b"]), "t"), (901, "odd", None, "t"), (902, "http://h0.org/0/0005", "<article><p>kept</p></article><p>open</p>", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in he.extract(df).collect()}
    assert len(got) == len(rows)
    assert (got[900], got[901], got[902]) == ("a\nb", "", "kept")
    for i, (host, path, lines) in want.items():
        own = [x for x in lines if x.startswith("h")]
        kept = got[i].split("\n") if got[i] else []
        assert [x for x in kept if x.startswith("h")] == own, "article lines stay"
        if sum(h == host for h, _, _ in want.values()) > 2:
            assert not any(x.startswith(("menu", "foot", "start")) for x in kept), kept


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "http://a.b/c", "<p>x</p>"), (1, "http://a.b/c", "<p>x</p>")], "page_id long, url string, html string")
    assert [r["text"] for r in he.extract(df).collect()] == ["x", "x"]
    assert he.extract(df.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op4_html_extract(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        source = pages[r["page_id"]]["html"]
        article = source[source.index("<article>") : source.index("</article>")]
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1|article)>", article)]
        assert r["text"] == "\n".join(x for x in lines if x) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_differencing_decides_on_marked_pages_as_well(spark):
    page = lambda i: f"<nav>Home</nav><div>menu</div><article><p>quoted</p><p>own {i}</p></article><div>odd {i}</div>"
    df = spark.createDataFrame([(i, f"http://h.org/{i}", page(i)) for i in range(3)], "page_id long, url string, html string")
    rows = sorted(he.extract(df).collect())
    assert [r.text for r in rows] == [f"quoted\nown {i}" for i in range(3)]
    # "Home", "menu" and "quoted" are shared with the neighbours; the marked article brings "quoted" back
    assert [(r.n_shared, r.n_restored) for r in rows] == [(3, 1)] * 3


def test_text_is_moved_once_and_never_written_in_between(spark, monkeypatch):
    written = []
    keep = he.materialize
    monkeypatch.setattr(he, "materialize", lambda df, name: written.append(df.columns) or keep(df, name))
    page = lambda i: f"<div>menu</div><div>own {i}</div><div></div><div>foot</div><div>more {i}</div>"
    df = spark.createDataFrame([(i, f"http://h.org/{i}", page(i)) for i in range(3)], "page_id long, url string, html string")
    out = he.extract(df)
    assert sorted((r.page_id, r.text, r.n_shared, r.n_restored) for r in out.collect()) == [(i, f"own {i}\nmore {i}", 2, 0) for i in range(3)]
    assert written and all(set(c) <= {"host", "path", "content", "hashes", "__part", "__at"} for c in written)


def test_no_kept_line_holds_a_line_feed():
    space = "".join(map(chr, [9, 10, 11, 12, 13, 28, 29, 30, 31, 133, 160, 8232, 8233]))
    assert all("\n" not in t for t, _ in he.page_lines(f"<p>a{space}b&#10;c</p><pre>d\n\ne</pre>"))

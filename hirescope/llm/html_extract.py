"""Main text of web pages.

A page is read as a list of text lines, one per block element, each with its
zone: chrome (menus, headers, footers, sidebars, notices, adverts, forms,
comments, by element or by class, id or role), article (inside an element that
marks the article) or open (neither).

Nearest-URL page differencing runs on every page: pages of a host are sorted
by URL path, each page is aligned with the page before and the page after it
by longest common subsequence of lines, and lines that either shares are
deleted.  An exact check by the page's own markup follows: chrome that varies
from page to page goes as well, and where a page marks its article, lines of
it that were deleted (neighbours quote the same passages) come back and lines
outside it go.  (Differencing alone is wrong on such pages; see the README for
figures.)

Only hashes of lines are sorted and aligned: a range sort by host and path
spreads a host of any size over tasks, and the rows at the edges of a task's
range are handed to its neighbours.  A page's text is moved at most once, to
the positions that the alignment found.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hirescope.llm.common import materialize
from hirescope.llm.url_filter import host_path

CHROME, OPEN, ARTICLE = 0, 1, 2

#: elements whose content is no text of the page
RAW = {"script", "style", "noscript", "template", "iframe", "object", "svg", "textarea", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    *"address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form".split(),
    *"h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary".split(),
    *"table tbody td tfoot th thead tr ul".split(),
}
CHROME_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "head"}
ARTICLE_TAGS = {"article", "main"}
#: elements that hold running text: inside an article their classes delete nothing
TEXT_TAGS = {"a", "abbr", "b", "blockquote", "code", "em", "h1", "h2", "h3", "h4", "h5", "h6", "i", "li", "mark", "p", "pre", "q", "small", "span", "strong", "td", "th"}
#: words of class, id and role that name chrome, and those that name the article
CHROME_WORDS = {
    *"ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies".split(),
    *"copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notification overlay".split(),
    *"pagination pager popup promo recommended related reply replies respond search share sharing sidebar signup social sponsor".split(),
    *"sponsored subscribe subscription toolbar widget widgets alert complementary contentinfo form dialog".split(),
}
ARTICLE_WORDS = {"articlebody", "main", "article"}

#: a comment, a tag, a tag with odd quotes, or a declaration.  Outside quotes a tag holds no "<", and a quoted value at
#: most ``VALUE`` characters, so every "<" is left after a bounded look ahead; one that opens no tag is text
VALUE = 1024
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^"]{{0,{VALUE}}}+"|'[^']{{0,{VALUE}}}+')*+)>|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>|<[!?][^<>]*+>""",
    re.S,
)
_NAMED = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z0-9]+")


def _zone_of(tag: str, attributes: str, zone: int, in_article: bool) -> int:
    """Zone inside an element that stands in ``zone``."""
    if zone == CHROME or tag in CHROME_TAGS or (tag == "header" and not in_article):
        return CHROME
    if attributes:
        # what names a text element of the article says nothing about where it stands
        named = CHROME_WORDS if zone != ARTICLE or tag not in TEXT_TAGS else set()
        for name, *values in _NAMED.findall(attributes):
            value = next((v for v in values if v), "").lower()
            words = set(_WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value)))
            if name.lower() != "itemprop" and words & named and tag not in ("body", "html", *ARTICLE_TAGS):
                return CHROME
            if name.lower() in ("itemprop", "role") and words & ARTICLE_WORDS:
                return ARTICLE
    return ARTICLE if tag in ARTICLE_TAGS else zone


def page_lines(page: str | None) -> list[tuple[str, int]]:
    """(line, zone) of every block of a page, in order.  Character references
    are decoded, white space inside a block is one space."""
    page = page or ""
    lines: list[tuple[str, int]] = []
    parts: list[str] = []
    open_tags: list[tuple[str, int]] = []  # element and the zone inside it
    zone, at = OPEN, 0

    def flush() -> None:
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                lines.append((text, zone))
            parts.clear()

    def close(index: int) -> None:
        nonlocal zone
        flush_needed = zone != (open_tags[index - 1][1] if index else OPEN)
        if flush_needed:
            flush()
        del open_tags[index:]
        zone = open_tags[-1][1] if open_tags else OPEN

    def find(tag: str, stop: tuple[str, ...] = ()) -> int:
        for i in range(len(open_tags) - 1, -1, -1):
            if open_tags[i][0] == tag:
                return i
            if open_tags[i][0] in stop:
                break
        return -1

    while True:
        token = _TOKEN.search(page, at)
        parts.append(page[at : token.start()] if token else page[at:])
        if token is None:
            break
        at = token.end()
        name = token[2] or token[5]
        if not name:
            continue
        tag, closing, attributes = name.lower(), bool(token[1] or token[4]), token[3] or token[6] or ""
        if tag == "br":
            parts.append(" ")
        if tag in BLOCKS:
            flush()
        if closing:
            index = find(tag)
            if index >= 0:
                close(index)
        elif tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not attributes.endswith("/"):
            if tag in BLOCKS:  # a block ends an open paragraph, an item the item before it
                index = find("p", ("article", "div", "td", "li", "body"))
                if index >= 0:
                    close(index)
                if tag in ("li", "td", "tr", "dd", "dt", "option"):
                    index = find(tag, ("ul", "ol", "table", "dl", "select"))
                    if index >= 0:
                        close(index)
            inside = _zone_of(tag, attributes, zone, zone == ARTICLE)
            if inside != zone:
                flush()
            open_tags.append((tag, inside))
            zone = inside
    flush()
    return lines


def common_lines(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``.

    Bit-parallel: one big integer per line of ``a``; above a fixed table size
    the problem is split in halves, so memory stays linear in the lines.
    """
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    middle = _lcs(a[start : len(a) - end], b[start : len(b) - end])
    return [*range(start), *(start + i for i in middle), *range(len(a) - end, len(a))]


TABLE_BITS = 1 << 27


def _rows(a: Sequence[int], b: Sequence[int]) -> Iterator[int]:
    """After each line of ``a``: a zero bit at every place of ``b`` where the
    length of the common subsequence grows by one."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
        yield row


def _lcs(a: Sequence[int], b: Sequence[int]) -> list[int]:
    keep = set(b)
    at = [i for i, x in enumerate(a) if x in keep]
    other = set(a)
    a, b = [a[i] for i in at], [x for x in b if x in other]
    if not a or not b:
        return []
    if len(a) == 1:
        return at
    if len(a) * len(b) > TABLE_BITS:
        half = len(a) // 2

        def lengths(x, y):
            for row in _rows(x, y):
                pass
            bits = np.unpackbits(np.frombuffer(row.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(y)]
            return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])

        cut = int(np.argmax(lengths(a[:half], b) + lengths(a[half:][::-1], b[::-1])[::-1]))
        return [at[i] for i in [*_lcs(a[:half], b[:cut]), *(half + i for i in _lcs(a[half:], b[cut:]))]]
    rows, out, j = list(_rows(a, b)), [], len(b) - 1
    for i in range(len(a) - 1, -1, -1):
        # step left to where the length last grew, then up while the row above has it as well
        while j >= 0 and rows[i] >> j & 1:
            j -= 1
        if j < 0:
            break
        if i and not rows[i - 1] >> j & 1:
            continue
        out.append(at[i])
        j -= 1
    return out[::-1]


def _hashes(lines: list[tuple[str, int]]) -> list[int]:
    import xxhash

    return [xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63) for text, _ in lines]


def _content(hashes: list[int]) -> int:
    """One number for all lines of a page."""
    import xxhash

    return xxhash.xxh64_intdigest(np.array(hashes, np.int64).tobytes()) - (1 << 63)


def _marked(lines: list[tuple[str, int]]) -> bool:
    return any(zone == ARTICLE for _, zone in lines)


def _neighbours(hashes: DataFrame) -> DataFrame:
    """``host``, ``content`` and ``shared`` (line positions) of every page that
    shares lines with a neighbour.  Copies within a host are one page."""
    keys = ["host", "path", "content"]
    pages = hashes.groupBy("host", "content").agg(F.min("path").alias("path"), F.first("hashes").alias("hashes"))
    names = pages.columns
    row = T.StructType([*pages.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__at", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())], [*names, "__part", "__at"])
            at += n

    parts = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = materialize(pages.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(number, row), "html-sorted")
    # the last row of each range precedes the next range that has rows, the first one follows the range before
    whole = F.struct(*table.columns)
    edges = table.groupBy("__part").agg(F.min_by(whole, "__at").alias("first"), F.max_by(whole, "__at").alias("last"))  # one row a range
    order = Window.orderBy("__part")
    beside = edges.select(F.lead("__part").over(order).alias("next"), F.lag("__part").over(order).alias("previous"), "first", "last")
    shown = [
        beside.where(f"{to} is not null").select(*(F.col(row_)[c].alias(c) for c in names), F.col(to).alias("__part"), F.lit(at).cast("long").alias("__at"))
        for to, row_, at in (("next", "last", -1), ("previous", "first", (1 << 62)))
    ]
    dealt = table.unionByName(shown[0]).unionByName(shown[1]).repartition(parts, "__part").sortWithinPartitions("__part", "__at")
    arrow = pa.schema([("host", pa.string()), ("content", pa.int64()), ("shared", pa.list_(pa.int32()))])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shared(page, other):
            if other is None or (other["__part"], other["host"]) != (page["__part"], page["host"]):
                return set()
            return set(common_lines(page["hashes"], other["hashes"]))

        def rows():
            before, page = None, None
            for batch in batches:
                for after in batch.to_pylist():
                    if page is not None:
                        yield before, page, after
                    before, page = page, after
            if page is not None:
                yield before, page, None

        for before, page, after in rows():
            if not page["host"] or page["__at"] in (-1, 1 << 62):
                continue
            found = sorted(shared(page, before) | shared(page, after))
            if not found:  # what joins the lines stays small
                continue
            yield pa.RecordBatch.from_pylist([{"host": page["host"], "content": page["content"], "shared": found}], schema=arrow)

    return dealt.mapInArrow(align, "host string, content long, shared array<int>")


def extract(df: DataFrame, id_cols: Sequence[str] = ("page_id",), url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_cols``, ``url``, ``text`` (blocks in page order, joined by one line
    feed), ``n_shared`` (lines that differencing deleted) and ``n_restored``
    (those of them that the page's marked article brought back) of every page.

    A null or empty page has an empty text.  Pages without a host (null or odd
    URLs) have no neighbours and keep their open lines; so does the only page
    of a host.  Pages of a host with the same lines are one page: they are no
    evidence against each other.  Repeated rows give repeated results.  Other
    columns are not read.  An empty table gives an empty result.
    """
    ids = list(id_cols)
    host, path = host_path(F.col(url_col))
    pages = df.select(*ids, F.col(url_col).alias("__url"), host.alias("__host"), path.alias("__path"), F.col(html_col).alias("__html"))
    n = len(ids)

    def line_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [_hashes(page_lines(x.as_py())) for x in batch.column(2)]
            out = [pa.array([_content(h) for h in hashes], pa.int64()), pa.array(hashes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *out], ["host", "path", "content", "hashes"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [page_lines(x.as_py()) for x in batch.column(n + 2)]
            marked = [_marked(p) for p in parsed]
            # what the markup lets stay: article lines of pages that mark them, else open lines; no line holds a line feed
            stay = [[i for i, (_, z) in enumerate(p) if z == (ARTICLE if m else OPEN)] for p, m in zip(parsed, marked)]
            out = [
                pa.array([_content(_hashes(p)) for p in parsed], pa.int64()), pa.array(marked, pa.bool_()), pa.array(stay, pa.list_(pa.int32())),
                pa.array(["\n".join(p[i][0] for i in at) for p, at in zip(parsed, stay)], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: n + 2], *out], [*ids, "__url", "__host", "__content", "__marked", "__at", "__text"])

    # pages are parsed twice: hashes for the alignment, then the text, which so is moved once, by the join, and never
    # written in between
    hashes = pages.select("__host", "__path", "__html").mapInArrow(line_hashes, "host string, path string, content long, hashes array<long>")
    shared = _neighbours(hashes).withColumnsRenamed({"host": "__host", "content": "__content"})
    more = "`__url` string, `__host` string, `__content` long, `__marked` boolean, `__at` array<int>, `__text` string"
    kinds = T.StructType([*(df.schema[c] for c in ids), *T.StructType.fromDDL(more).fields])
    judged = pages.drop("__path").mapInArrow(texts, kinds).join(shared, ["__host", "__content"], "left")
    gone = F.coalesce("shared", F.array().cast("array<int>"))
    back = F.when(F.col("__marked"), F.array_intersect("__gone", "__at")).otherwise(F.array().cast("array<int>"))
    judged = judged.withColumn("__gone", gone).withColumn("__back", back).withColumn("__out", F.array_except("__gone", "__back"))
    left = F.filter(F.split("__text", "\n"), lambda line, i: ~F.array_contains("__out", F.get("__at", i)))
    text = F.when(F.size(F.array_intersect("__out", "__at")) == 0, F.col("__text")).otherwise(F.array_join(left, "\n"))
    return judged.select(
        *ids, F.col("__url").alias("url"), text.alias("text"),
        F.size("__gone").cast("long").alias("n_shared"), F.size("__back").cast("long").alias("n_restored"),
    )

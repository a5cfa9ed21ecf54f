"""Personal data by bootstrapped contextual extraction.

Four kinds of entities (email, ip, card, phone) are found by fixed patterns
with their checks; these are the base spans.  They are also the seeds of a
bootstrap: every identifier-like token (an entity, or a token with a digit) is
an instance, and the two words before it are its lexical pattern.  Spark
scores the graph of patterns and instances in rounds: a pattern's score for a
kind is the mean confidence of its distinct instances, an instance's
confidence is the noisy-or of the scores of its accepted patterns.  Rounds end
when nothing changes any more.  Patterns that score high and have enough known instances find identifiers that the
fixed patterns do not cover; their spans are added to the base ones.

Everything is DataFrame expressions and joins; no Python runs on the
executors.  Texts are read once and are not shuffled: what is shuffled are
occurrences of instances, reduced to distinct pattern-instance pairs first.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from hirescope.llm.common import SPACE_CLASS, materialize

KINDS = ("email", "ip", "card", "phone")

# The base patterns, written so that Java's matcher neither recurses per repetition (possessive
# groups) nor tries every start inside a long run (a match starts where the run does, or where
# the last match ended); what they match is unchanged.
_LOCAL = "A-Za-z0-9._%+-"
_LABEL = "[A-Za-z0-9-]++"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@{_LABEL}(?:\.{_LABEL})++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: punctuation that is not part of an identifier at its ends
EDGES = "\"'`()[]{}<>,;:.!?*#$%&|="
#: where a token ends but for such punctuation; the rest of a token up to a list's next item
_STOP = rf"(?=[{re.escape(EDGES)}]*+(?![^{SPACE_CLASS}]))"
_REST = rf"[^{SPACE_CLASS},;|]*+[,;|]*+"
#: a token with a digit, from its first character (or where a list's item before it ended) to its last
_TOKEN = rf"(?:\G|(?<![^{SPACE_CLASS}]))[^{SPACE_CLASS}0-9]*+[0-9][^{SPACE_CLASS}]*+"
#: tokens of digits with single hyphens, one space apart
_RUN = rf"[0-9]++(?:-[0-9]++)*+{_STOP}"
_RUNS = rf"{_RUN}(?:\x20{_RUN})*+"
#: the digits of a card, and those of a card in groups of four; the least and the further digits of a phone
_CARD = r"[0-9](?:[\x20-]?[0-9]){15,18}"
_GROUPS = r"[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?:[\x20-]?[0-9]){0,3}+(?![\x20-]?[0-9])"
_PHONE, _MORE = r"\+[0-9](?:[\x20().-]*+[0-9]){7}", r"(?:[\x20().0-9-]*[0-9])?"
# A phone or a run of digits is an instance only as whole tokens, cut back to a token's end if it ends inside one;
# a phone or card that ends at no token's end is one with the rest of its token.  Any other token is taken whole.
INSTANCE = "|".join(
    [
        rf"{_PHONE}{_MORE}{_STOP}",
        rf"{_PHONE}{_MORE}+{_REST}",
        PATTERNS["phone"] + _STOP,
        rf"(?={_CARD}{_STOP}){_RUNS}",
        rf"{_GROUPS}{_REST}",
        _RUNS,
        _TOKEN,
        PATTERNS["email"],
    ]
)
#: a pattern of more characters is told by its hash
PATTERN_CHARS = 64
MIN_CHARS = 5
#: rounds after which a bootstrap that has not come to rest is an error
ROUNDS = 100
#: least score and least known instances of an accepted pattern; least confidence of an accepted instance
MIN_SCORE = 0.8
MIN_SUPPORT = 5
MIN_CONFIDENCE = 0.8
#: matches or characters handled as one block inside a row
BLOCK = 256
TEXT_BLOCK = 4096

SPANS = "array<struct<kind:string,start:int,end:int>>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), body)[0]


def _matches(text: Column, pattern: str) -> Column:
    """Array of struct (start, gap, m): every match ``m``, the text ``gap``
    between the match before and it, and its start in code points.

    Starts are running sums of the lengths of gaps and matches, taken in
    blocks, so that a text of very many matches stays near linear."""
    kind = "array<struct<start:int,gap:string,m:string>>"

    def in_block(block: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

        def step(acc, x):
            start = acc["at"] + F.length(x["gap"])
            return F.struct((start + F.length(x["m"])).alias("at"), F.array_append(acc["out"], F.struct(start.alias("start"), x["gap"].alias("gap"), x["m"].alias("m"))).alias("out"))

        return F.aggregate(block, zero, step)

    def joined(blocks: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))

        def step(acc, b):
            moved = F.transform(b["out"], lambda x: F.struct((x["start"] + acc["at"]).alias("start"), x["gap"].alias("gap"), x["m"].alias("m")))
            return F.struct((acc["at"] + b["at"]).alias("at"), F.array_append(acc["out"], moved).alias("out"))

        return F.flatten(F.aggregate(blocks, zero, step, lambda acc: acc["out"]))

    def of(pair: Column) -> Column:
        items = F.transform(pair["ms"], lambda m, i: F.struct(F.get(pair["gaps"], i).alias("gap"), m.alias("m")))
        return F.when(F.size(pair["ms"]) == 0, F.array().cast(kind)).otherwise(_let(items, cut))

    def cut(items: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
        return joined(F.transform(firsts, lambda b: in_block(F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))))

    return _let(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("ms")), of)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, i):
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return _let(_digits(m), lambda d: F.length(d).between(16, 19) & F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """The base spans of one kind (``SPANS``), in order."""
    sign = {"email": "@", "phone": "+", "ip": "."}.get(kind)
    found = F.filter(_matches(text, PATTERNS[kind]), lambda x: _valid(kind, x["m"]))
    spans = F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["m"])).alias("end")))
    possible = text.rlike("[0-9]") if sign is None else F.contains(text, F.lit(sign))
    return F.when(possible, spans).otherwise(F.array()).cast(SPANS)


def _kind_of(m: Column) -> Column:
    """The kind of the base entity that an instance is or holds."""
    return F.when(m.rlike(PATTERNS["email"]), "email").when(_holds("ip", m), "ip").when(_holds("card", m), "card").when(_holds("phone", m), "phone")


def _holds(kind: str, m: Column) -> Column:
    return _let(F.regexp_extract(m, PATTERNS[kind], 0), lambda x: (x != "") & _valid(kind, x))


def _last_words(words: Column) -> Column:
    """The last two of words that single spaces separate."""
    return F.substring_index(words, " ", -2)


def instances(text: Column) -> Column:
    """Array of struct (start, end, pattern, instance, seed) of a text's
    identifier-like tokens; seed is the kind of a base entity, else null.

    The pattern is the two words before an instance, however far, or the one
    word if the text starts with it; an instance at a text's start has none
    and is left out.  An instance before it is one word, in which an email is
    "@" and all from the first digit to the last is "0"."""

    def words(x: Column, i: Column) -> Column:
        core = F.btrim(x["m"], F.lit(EDGES))
        own = F.when(F.contains(core, F.lit("@")), "@").otherwise(F.regexp_replace(F.lower(core), "(?s)[0-9](?:.*[0-9])?", "0"))
        # punctuation after an instance is no word
        gap = F.when(i == 0, x["gap"]).otherwise(F.ltrim(x["gap"], F.lit(EDGES)))
        between = F.lower(_last_words(F.btrim(F.regexp_replace(gap, f"[{SPACE_CLASS}]++", " "))))
        start = x["start"] + F.length(x["m"]) - F.length(F.ltrim(x["m"], F.lit(EDGES)))
        return F.struct(start.alias("start"), core.alias("core"), own.alias("own"), F.nullif(between, F.lit("")).alias("between"))

    def of(x: Column, i: Column, items: Column) -> Column:
        before, second = F.get(items, i - 1), F.get(items, i - 2)
        context = _last_words(F.concat_ws(" ", second["own"], before["between"], before["own"], x["between"]))
        pattern = _let(context, lambda c: F.when(F.length(c) > PATTERN_CHARS, F.sha2(c.cast("binary"), 256)).otherwise(c))
        end = x["start"] + F.length(x["core"])
        return F.struct(x["start"].alias("start"), end.alias("end"), pattern.alias("pattern"), F.lower(x["core"]).alias("instance"), _kind_of(x["core"]).alias("seed"))

    found = _let(F.transform(_matches(text, INSTANCE), words), lambda items: F.transform(items, lambda x, i: of(x, i, items)))
    kept = F.filter(found, lambda x: (x["pattern"] != "") & (x["end"] - x["start"] >= MIN_CHARS))
    return F.when(text.rlike("[0-9@]"), kept).otherwise(F.array()).cast("array<struct<start:int,end:int,pattern:string,instance:string,seed:string>>")


def bootstrap(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Accepted patterns (pattern, kind, score) and accepted instances
    (instance, kind, confidence; seeds have 1) of distinct ``edges`` (pattern,
    instance, seed).

    Rounds are repeated until the accepted instances and their confidences (to
    six places), and so the patterns, no longer change; more than ``rounds``
    are an error."""
    seeds = edges.where("seed is not null").groupBy("instance").agg(F.min("seed").alias("kind")).withColumn("confidence", F.lit(1.0))
    known = seeds
    state = _state(known)
    for _ in range(rounds):
        rated = edges.select("pattern", "instance").join(known, "instance", "left")
        sums = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("confidence"))), F.lit(0.0)).alias(k) for k in KINDS]
        support = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS]
        by_pattern = rated.groupBy("pattern").agg(F.count("*").alias("n"), *sums, *support)
        best = F.greatest(*(F.struct((F.col(k) / F.col("n")).alias("score"), F.col(f"n_{k}").alias("support"), F.lit(k).alias("kind")) for k in KINDS))
        patterns = materialize(
            by_pattern.select("pattern", best.alias("b")).where((F.col("b.score") >= MIN_SCORE) & (F.col("b.support") >= MIN_SUPPORT)).select("pattern", "b.kind", "b.score"), "pii-patterns"
        )
        # noisy-or over the accepted patterns of an instance; a perfect score counts as nearly one
        doubt = F.exp(F.sum(F.log(1 - F.least(F.col("score"), F.lit(0.999)))))
        found = edges.where("seed is null").join(patterns, "pattern").groupBy("instance", "kind").agg((1 - doubt).alias("confidence"))
        best = found.where(F.col("confidence") >= MIN_CONFIDENCE).groupBy("instance").agg(F.max(F.struct("confidence", "kind")).alias("b"))
        known = materialize(seeds.unionByName(best.join(seeds, "instance", "left_anti").select("instance", "b.kind", "b.confidence")), "pii-instances")
        before, state = state, _state(known)
        if state == before:
            return patterns, known
    raise RuntimeError(f"patterns and instances still change after {rounds} rounds")


def _state(known: DataFrame) -> Row:
    """Count and hash sum of instances, kinds and confidences."""
    return known.agg(F.count("*"), F.sum(F.xxhash64("instance", "kind", F.round("confidence", 6)).cast("decimal(38,0)"))).first()


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _ordered(spans: Column) -> Column:
    """Spans by kind as listed, then start, then end; each once."""
    place = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(place(s).alias("p"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.sort_array(F.array_distinct(keyed)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def row_key(df: DataFrame, text_col: str = "text") -> Column:
    """Tells rows of one id apart by their texts."""
    return F.xxhash64(F.coalesce(df[text_col], F.lit("")))


def find(df: DataFrame, id_cols: Sequence[str] = ("doc_id",), text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``id_cols`` and ``__key`` (of the text) of every row with ``base`` and
    ``spans``: arrays of struct (kind, start, end), code points, end exclusive,
    by kind and start; ``spans`` holds the base ones and those discovered.

    A null text is an empty one and has no spans; texts without digits and "@"
    cost one scan.  Repeated rows have the same spans.  An instance that is a
    base entity anywhere is never added under another kind; with too few known
    instances nothing is added.  Columns that are not named are not read.  An
    empty table gives an empty result.
    """
    ids = list(id_cols)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(*(base_spans(F.col("__text"), k) for k in KINDS))
    source = df.select(*ids, row_key(df, text_col).alias("__key"), text.alias("__text"))
    rows = materialize(source.select(*ids, "__key", base.alias("base"), instances(F.col("__text")).alias("__found")), "pii-rows")
    seen = rows.select(*ids, "__key", F.explode("__found").alias("x")).select(*ids, "__key", "x.*")
    edges = materialize(seen.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pii-edges")
    patterns, known = bootstrap(edges, rounds)
    new = seen.where("seed is null").join(patterns.select("pattern", "kind"), "pattern").join(known.select("instance", "kind"), ["instance", "kind"])
    added = new.groupBy(*ids, "__key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("__added"))
    r, a = rows.alias("r"), added.alias("a")
    same = F.col("r.__key") == F.col("a.__key")
    for c in ids:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"a.{c}"))
    spans = F.when(F.col("a.__added").isNull(), F.col("r.base")).otherwise(_ordered(F.concat("r.base", F.col("a.__added").cast(SPANS))))
    return r.join(a, same, "left").select(*(f"r.{c}" for c in ids), "r.__key", "r.base", spans.alias("spans"))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    counts = [F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(id_col, *counts, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind, like ``[EMAIL]``; of
    overlapping spans the first is named.  Works a block of text at a time."""

    def block(b: Column, ordered: Column) -> Column:
        own = F.filter(ordered, lambda s: (s["start"] < b["at"] + TEXT_BLOCK) & (s["end"] > b["at"]))

        def step(acc, s):
            before = F.substring(b["s"], acc["at"] - b["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"]))
            label = F.when(s["start"] >= acc["at"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], before, label).alias("out"))

        zero = F.struct(b["at"].alias("at"), F.lit("").alias("out"))
        # what a span of an earlier block covers at the start of this one is skipped
        return F.aggregate(own, zero, step, lambda acc: F.concat(acc["out"], F.substring(b["s"], acc["at"] - b["at"] + 1, F.greatest(F.lit(0), b["at"] + TEXT_BLOCK - acc["at"]))))

    def whole(p: Column) -> Column:
        ordered = F.sort_array(F.transform(p["spans"], lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
        firsts = F.sequence(F.lit(0), F.floor((F.length(p["text"]) - 1) / TEXT_BLOCK).cast("int"))
        return _let(ordered, lambda o: F.array_join(F.transform(firsts, lambda i: block_at(p, i, o)), ""))

    def block_at(p: Column, i: Column, ordered: Column) -> Column:
        cut = F.struct((i * TEXT_BLOCK).alias("at"), F.substring(p["text"], i * TEXT_BLOCK + 1, F.lit(TEXT_BLOCK)).alias("s"))
        return _let(cut, lambda b: block(b, ordered))

    return F.when(F.size(spans) > 0, _let(F.struct(text.alias("text"), spans.alias("spans")), whole)).otherwise(text)

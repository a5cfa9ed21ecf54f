"""Quality rules: statistics of whole texts and a learned decision list.

All statistics are DataFrame expressions (no Python runs on the executors).
The decision list is learned from labelled rows by sequential covering: a rule
is a conjunction of threshold tests, grown test by test on two thirds of the
rows by information gain, pruned on the other third, and kept if it is precise
there; the rows it covers are removed and the next rule is sought.  Every step
needs only counts by feature, threshold and label, which Spark aggregates over
all labelled rows; the driver sees those counts, never rows.  The list is
emitted as one ordered conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import SPACE_CLASS, materialize

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: words of a repeated window
REPEAT_WORDS = 5
#: base rule: least words, and most percent of words in repeated windows
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: thresholds tried for each feature and label, rules, tests of a rule
THRESHOLDS = 24
MAX_RULES = 8
MAX_TESTS = 3
#: least precision of a rule on the pruning rows, and least rows it rejects rightly there
MIN_PRECISION = 0.9
MIN_SUPPORT = 3
#: every so many labelled rows one prunes, the others grow
PRUNE_EVERY = 3

FEATURES = ("n_words", "mean_word_chars", "symbols_per_word", "dup_line_share", "repeat_share", "distinct_share")

#: a test: feature, ">" or "<=", threshold; a rule is a list of tests that all hold
Test = tuple[str, str, float]


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in windows that occur twice or more in the text."""
    k = REPEAT_WORDS

    def marked(pairs: Column) -> Column:
        same = lambda i, x: F.coalesce(F.get(pairs, i)["h"] == x["h"], F.lit(False))
        twice = F.filter(pairs, lambda x, i: same(i - 1, x) | same(i + 1, x))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        # a window adds the words that the one before it has not covered
        zero = F.struct(F.lit(0).alias("n"), F.lit(-k).alias("last"))
        return F.aggregate(starts, zero, lambda acc, i: F.struct((acc["n"] + F.least(F.lit(k), i - acc["last"])).alias("n"), i.alias("last")), lambda acc: acc["n"])

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_let(pairs, marked))

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.xxhash64(F.slice(words, i, F.lit(k))))
    return F.when(F.size(words) < k, F.lit(0)).otherwise(_let(windows, covered))


def statistics(text: Column) -> Column:
    """A struct of the base statistics (long) and the features (double)."""
    text = F.coalesce(text, F.lit(""))

    def of(pair: Column) -> Column:
        whole, words = pair["text"], pair["words"]
        lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(f"[^{SPACE_CLASS}]"))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
        )

    trimmed = F.btrim(text, F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE_CLASS}]+"))
    return _let(F.struct(text.alias("text"), words.alias("words")), of)


def with_statistics(df: DataFrame, columns: Sequence[str], text_col: str = "text") -> DataFrame:
    """``columns`` and ``__stats``, a struct of statistics and features."""
    return df.select(*columns, statistics(F.col(text_col)).alias("__stats"))


def features(stats: Column) -> dict[str, Column]:
    per = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return {
        "n_words": stats["n_words"].cast("double"),
        "mean_word_chars": per(stats["word_chars"], stats["n_words"]),
        "symbols_per_word": per(stats["n_symbols"], stats["n_words"]),
        "dup_line_share": per(stats["n_dup_lines"], stats["n_lines"]),
        "repeat_share": per(stats["n_repeat_words"], stats["n_words"]),
        "distinct_share": per(stats["n_distinct"], stats["n_words"]),
    }


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (stats["n_repeat_words"] * 100 > stats["n_words"] * MAX_REPEAT_PERCENT)


def _holds(tests: Sequence[Test], columns) -> Column:
    out = F.lit(True)
    for feature, sign, threshold in tests:
        out = out & (columns[feature] > threshold if sign == ">" else columns[feature] <= threshold)
    return out


def _bin(feature: str, thresholds: Sequence[float]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, thresholds)), lambda t: F.col(feature) > t))


def learn(rows: DataFrame, id_col: str = "doc_id", bad_col: str = "bad", max_rules: int = MAX_RULES) -> list[list[Test]]:
    """The rejecting rules, in order, from a table of ``id_col``, ``bad_col``
    (boolean) and the columns of ``FEATURES``.  Rows with a null label count
    for neither side; no labelled rows give no rules."""
    rows = rows.where(F.col(bad_col).isNotNull())
    cuts = rows.groupBy(bad_col).agg(*(F.percentile_approx(f, [i / THRESHOLDS for i in range(1, THRESHOLDS)], 10_000).alias(f) for f in FEATURES)).collect()
    if len(cuts) < 2:
        return []
    thresholds = {f: sorted({v for r in cuts for v in r[f]}) for f in FEATURES}
    # a value's bin is the number of thresholds below it: value > t[k] is bin > k
    bins = F.array(*(_bin(f, thresholds[f]) for f in FEATURES))
    table = materialize(rows.select(bad_col, *FEATURES, bins.alias("__bins"), (F.pmod(F.xxhash64(id_col), F.lit(PRUNE_EVERY)) == 0).alias("__prunes")), "quality-labelled")
    rules: list[list[Test]] = []
    while len(rules) < max_rules:
        left = table
        for rule in rules:
            left = left.where(~_holds(rule, table))
        tests = _grow(left.where("not __prunes"), bad_col, thresholds)
        sums = [F.count_if(_holds(tests[:n], table) & (F.col(bad_col) == bad)) for n in range(1, len(tests) + 1) for bad in (True, False)]
        found = list(left.where("__prunes").agg(*sums).first()) if tests else []
        # the shortest conjunction of the best precision on the pruning rows
        best = max(range(0, len(found), 2), key=lambda i: ((found[i] - found[i + 1]) / max(1, found[i] + found[i + 1]), -i), default=None)
        if best is None or found[best] < MIN_SUPPORT or found[best] < MIN_PRECISION * (found[best] + found[best + 1]):
            break
        rules.append(tests[: best // 2 + 1])
    return rules


def _grow(rows: DataFrame, bad_col: str, thresholds: dict[str, list[float]]) -> list[Test]:
    """Tests added one by one, each of the greatest information gain."""
    tests: list[Test] = []
    while len(tests) < MAX_TESTS:
        counts = (
            rows.where(_holds(tests, rows))
            .select(bad_col, F.posexplode("__bins").alias("f", "bin"))
            .groupBy("f", "bin")
            .agg(F.count_if(F.col(bad_col)).alias("p"), F.count_if(~F.col(bad_col)).alias("n"))
            .collect()  # features times thresholds rows
        )
        p, n = (sum(r[c] for r in counts if r["f"] == 0) for c in ("p", "n"))
        if not p or not n:
            break
        best: tuple[float, Test | None] = (0.0, None)
        for f, name in enumerate(FEATURES):
            own = {r["bin"]: (r["p"], r["n"]) for r in counts if r["f"] == f}
            low = [0, 0]
            for k, threshold in enumerate(thresholds[name]):
                low = [a + b for a, b in zip(low, own.get(k, (0, 0)))]
                for sign, (a, b) in (("<=", low), (">", (p - low[0], n - low[1]))):
                    if a:
                        gain = a * (math.log2(a / (a + b)) - math.log2(p / (p + n)))
                        if gain > best[0] + 1e-9:
                            best = gain, (name, sign, threshold)
        if best[1] is None:
            break
        tests.append(best[1])
    return tests


def verdict(rules: Sequence[Sequence[Test]], stats: Column) -> Column:
    """The decision list as one ordered conditional expression: true keeps."""
    columns, out = features(stats), None
    for rule in rules:
        out = F.when(_holds(rule, columns), F.lit(False)) if out is None else out.when(_holds(rule, columns), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def labelled(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality") -> DataFrame:
    """Rows to learn from: what passes the base rules and has a label."""
    rows = stats.where(~base_failed(F.col("__stats"))).select(id_col, *(c.alias(f) for f, c in features(F.col("__stats")).items()))
    return rows.join(labels.where(F.col(quality_col).isNotNull()).select(id_col, (F.col(quality_col) == 0).alias("bad")).distinct(), id_col)


def judge(df: DataFrame, labels: DataFrame, columns: Sequence[str] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality") -> DataFrame:
    """``columns`` of every row with ``__stats`` (struct), ``base_failed`` and
    ``kept``.

    ``labels`` has ``id_col`` and ``quality_col`` (0 is bad).  A null text is
    an empty one; texts of fewer than ten words fail the base rules.  Labels of
    ids that are not in ``df``, null labels and repeated labels change nothing;
    with no labels of both kinds nothing but the base rules rejects.  Repeated
    rows are judged alike.  Columns that are not named are not read.  An empty
    table gives an empty result.
    """
    columns = list(dict.fromkeys([*columns, id_col]))
    table = materialize(with_statistics(df, columns, text_col), "quality-statistics")
    rules = learn(labelled(table, labels, id_col, quality_col), id_col)
    failed = base_failed(F.col("__stats"))
    return table.select(*columns, "__stats", failed.alias("base_failed"), (~failed & verdict(rules, F.col("__stats"))).alias("kept"))

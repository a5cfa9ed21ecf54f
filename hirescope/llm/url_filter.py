"""URL filter: host and path rules, and character language models where no
rule speaks.

URLs that a rule accepts or rejects train two character models.  Both are
variable-order Markov models: the probability of a character after its last
``ORDER`` characters is interpolated with that after ever shorter contexts, as
far as each context has been seen (Witten-Bell), down to a uniform one.  The
score of a URL is the difference of its log-likelihoods under the two models
per character; the threshold is calibrated on a held-out fifth of the ruled
URLs.

Characters are mapped to a fixed alphabet, so a model is a dense table whose
size is known in advance (alphabet ** (order + 1) numbers).  Counting is one
Spark aggregation that combines map-side; scoring needs no join or shuffle:
the table of log ratios reaches every row as one scalar subquery.  All steps
are DataFrame expressions; no Python runs on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import materialize

#: rule: verdict and pattern; what stands before the first "/" is the host, the rest begins the path
Rule = tuple[str, str]
RULES: tuple[Rule, ...] = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: one character of the model for each of these; digits share one, others share the last
LETTERS = "abcdefghijklmnopqrstuvwxyz"
MARKS = "/._-"
ALPHABET = len(LETTERS) + len(MARKS) + 2
ORDER = 2
#: every so many ruled URLs one calibrates, the others train
CALIBRATE_EVERY = 5
#: scores are calibrated on a grid of this step
GRID = 0.01


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty without "://"."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null.

    Rules of equal length that both fit a URL would have equal hosts and paths,
    so the order of equal ones does not matter."""
    out = None
    for verdict, pattern in sorted(rules, key=lambda r: -len(r[1])):
        rule_host, _, rest = pattern.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit("/" + rest))
        value = F.struct(F.lit(pattern).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def codes(text: Column) -> Column:
    """Array of the alphabet's numbers of a text's characters, with ``ORDER``
    end marks before and one after (the mark of other characters)."""
    lower = F.lower(text)
    # one character each: letters and marks stand for themselves, a digit for "0", others for " "
    plain = F.regexp_replace(F.regexp_replace(lower, "[0-9]", "0"), rf"[^0{LETTERS}{MARKS}]", " ")
    padded = F.concat(F.lit(" " * ORDER), plain, F.lit(" "))
    return F.transform(F.split(padded, ""), lambda c: F.when(c == " ", ALPHABET - 1).otherwise(_number(c)))


def _number(c: Column) -> Column:
    letter = F.ascii(c) - ord("a")
    marks = F.when(c == "0", len(LETTERS) + len(MARKS))
    for i, mark in enumerate(MARKS):
        marks = marks.when(c == mark, len(LETTERS) + i)
    return marks.otherwise(letter)


def _grams(numbers: Column) -> Column:
    """Index of every character with its context in the dense table."""

    def at(x: Column, i: Column) -> Column:
        out = F.get(x, i - ORDER)
        for k in range(ORDER - 1, -1, -1):
            out = out * ALPHABET + F.get(x, i - k)
        return out

    return F.transform(F.array(numbers), lambda x: F.transform(F.sequence(F.lit(ORDER), F.size(x) - 1), lambda i: at(x, i)))[0]


def log_ratios(counts: dict[int, tuple[int, int]]) -> list[float]:
    """The dense table of log P(accepted) - log P(rejected) of each character
    after its context, from the counts of whole contexts with characters."""
    size = ALPHABET ** (ORDER + 1)
    tables = []
    for side in (0, 1):
        probability = [1.0 / ALPHABET]  # of order -1, the same for every character
        for order in range(ORDER + 1):
            width = ALPHABET ** (order + 1)
            seen = [0] * width
            for index, pair in counts.items():
                seen[index % width] += pair[side]
            refined = [0.0] * width
            for context in range(width // ALPHABET):
                own = seen[context * ALPHABET : (context + 1) * ALPHABET]
                total, kinds = sum(own), sum(1 for n in own if n)
                for c in range(ALPHABET):
                    shorter = probability[(context * ALPHABET + c) % len(probability)]
                    refined[context * ALPHABET + c] = (own[c] + kinds * shorter) / (total + kinds) if total else shorter
            probability = refined
        tables.append(probability)
    return [math.log(a) - math.log(b) for a, b in zip(*tables)] if counts else [0.0] * size


def _calibrate(table: DataFrame) -> float:
    """The threshold of the best balanced accuracy; accepted scores are higher."""
    bins = table.groupBy(F.floor(F.col("score") / GRID).alias("b")).agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r")).collect()
    accepted, rejected = sum(r["a"] for r in bins), sum(r["r"] for r in bins)
    if not accepted or not rejected:
        return 0.0
    bins.sort(key=lambda r: r["b"])
    best, below_a, below_r = (0.5, 0.0), 0, 0
    for r, following in zip(bins, [*(x["b"] for x in bins[1:]), bins[-1]["b"] + 1]):
        below_a, below_r = below_a + r["a"], below_r + r["r"]
        share = ((accepted - below_a) / accepted + below_r / rejected) / 2
        best = max(best, (share, (r["b"] + 1 + following) / 2 * GRID))  # halfway to the next score seen
    return best[1]


def judge(df: DataFrame, id_cols: Sequence[str] = ("page_id",), url_col: str = "url", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``id_cols``, ``host``, ``path``, ``rule``, ``verdict`` and ``score``
    (null where a rule decides) of every row.

    The text scored is host and path.  A null or malformed URL has an empty
    host and path and is scored as an empty text.  If only one side or neither
    has ruled URLs, every score is 0 and the verdict is allow.  Repeated URLs
    count as often as they occur.  Columns that are not named are not read.
    An empty table gives an empty result.
    """
    ids = list(id_cols)
    host, path = host_path(F.col(url_col))
    table = df.select(*ids, host.alias("host"), path.alias("path")).withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    ruled = table.where("__rule is not null").select((F.col("__rule.verdict") == "allow").alias("accepted"), F.concat("host", "path").alias("text"), (F.pmod(F.xxhash64("host", "path"), F.lit(CALIBRATE_EVERY)) == 0).alias("held"))
    grams = ruled.where("not held").select("accepted", F.explode(_grams(codes(F.col("text")))).alias("gram"))
    counted = grams.groupBy("gram").agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r")).collect()  # at most the table's size
    both = all(sum(r[c] for r in counted) for c in ("a", "r"))
    ratios = log_ratios({r["gram"]: (r["a"], r["r"]) for r in counted} if both else {})
    spark = df.sparkSession
    model = materialize(spark.createDataFrame([(ratios,)], "ratios array<float>"), "url-model")

    def score(text: Column) -> Column:
        def mean(x: Column) -> Column:
            grams, ratio = x["grams"], x["ratios"]
            return F.aggregate(grams, F.lit(0.0), lambda total, g: total + F.get(ratio, g)) / F.size(grams)

        return F.transform(F.array(F.struct(_grams(codes(text)).alias("grams"), F.col("__ratios").alias("ratios"))), mean)[0]

    threshold = _calibrate(ruled.where("held").withColumn("__ratios", model.scalar()).select("accepted", score(F.col("text")).alias("score"))) if both else 0.0
    scored = table.withColumn("__ratios", model.scalar()).withColumn("score", F.when(F.col("__rule").isNull(), score(F.concat("host", "path"))))
    verdict = F.coalesce("__rule.verdict", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return scored.select(*ids, "host", "path", F.col("__rule.rule").alias("rule"), verdict.alias("verdict"), "score")

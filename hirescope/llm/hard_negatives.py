"""Hard negatives by spanning-tree bounds over anchors.

An anchor's positives are the rows of its label with the largest inner
products; for each of them its hard negatives are the best rows of other
labels whose score lies in a window below the positive's.

The anchors of a block are joined by a spanning tree of their shortest
distances.  A row ``x`` scored at a parent anchor is bounded at the child: its
score can change by at most the edge's length times the length of ``x``.  Only
rows whose bounds overlap what the child is looking for are scored again, the
others hand their wider bounds on; so every result is exact, and near anchors
score few rows.

Rows are dealt out in stripes of a fixed size by a hash of their id.  A stripe
stays in memory while all anchors stream by in blocks, so memory is that of
one stripe and one block, whatever the number of rows, anchors or rows of one
label.  Each stripe returns its best few, which a window function merges.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirescope.llm.common import materialize

POSITIVES = 5
NEGATIVES = 10
#: a negative's score in hundredths of the positive's
LOW, HIGH = 30, 90
#: rows of a stripe, and anchors of a block
STRIPE = 16384
BLOCK = 256
#: integers up to here are exact in double precision
EXACT = 1 << 53


def prepared(df: DataFrame, anchors: Column, label: Column, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, label, vector of whole numbers, anchor) of the rows that take part,
    one for each id, written to the shared folder."""
    vector = F.col(vector_col)
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floors = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    used = df.where(F.col(id_col).isNotNull() & label.isNotNull() & F.coalesce(whole, F.lit(False)))
    rows = used.select(F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"), floors.alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    one = rows.groupBy("id").agg(F.min(F.struct("label", "vector", "anchor")).alias("row"))
    return materialize(one.select("id", "row.*"), "negatives-rows")


class Vectors:
    """Vectors of whole numbers, and their lengths; exact products in double
    precision while they fit, in Python's integers beyond."""

    def __init__(self, whole: np.ndarray):
        if whole.size and (whole.max() == np.iinfo(np.int64).max or whole.min() == np.iinfo(np.int64).min):
            raise OverflowError("a vector's component does not fit 64 bits")
        self.whole = whole
        self.double = whole.astype(np.float64)
        self.lengths = np.sqrt((self.double * self.double).sum(axis=1))

    def scores(self, at: np.ndarray, query: np.ndarray, length: float) -> np.ndarray:
        if (self.lengths[at].max(initial=0.0) + 1) * (length + 1) < EXACT:
            return (self.double[at] @ query.astype(np.float64)).astype(np.int64)
        # raises OverflowError if a score does not fit 64 bits
        return np.array([sum(a * b for a, b in zip(row, query.tolist())) for row in self.whole[at].tolist()], np.int64)


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float]]:
    """(anchor, parent, distance) of a tree of shortest distances, parents first; the first has parent -1."""
    best, parent = np.full(len(vectors), np.inf), np.zeros(len(vectors), np.int64)
    steps, new = [(0, -1, 0.0)], 0
    outside = np.ones(len(vectors), bool)
    for _ in range(len(vectors) - 1):
        outside[new] = False
        away = np.sqrt(((vectors - vectors[new]) ** 2).sum(axis=1))
        nearer = away < best
        best[nearer], parent[nearer] = away[nearer], new
        new = int(np.where(outside, best, np.inf).argmin())
        steps.append((new, int(parent[new]), float(best[new])))
    return steps


def walk(anchors: Vectors, rows: Vectors, choose: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every anchor, parents first: the rows that ``choose(anchor, low,
    high)`` picks by the bounds of their scores, with their exact scores.  All
    rows are scored at the first anchor."""
    steps = spanning_tree(anchors.double)
    children = Counter(parent for _, parent, _ in steps)
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for anchor, parent, edge in steps:
        if parent < 0:
            low = rows.scores(np.arange(len(rows.lengths)), anchors.whole[anchor], anchors.lengths[anchor]).astype(np.float64)
            high = low.copy()
        else:
            # the edge, and what rounding can add to lengths and scores
            reach = edge + 1e-9 * (anchors.lengths[anchor] + anchors.lengths[parent])
            spread = rows.lengths * reach * (1 + 1e-9) + 1
            low, high = bounds[parent][0] - spread, bounds[parent][1] + spread
            children[parent] -= 1
            if not children[parent]:
                del bounds[parent]
        at = choose(anchor, low, high)
        scores = rows.scores(at, anchors.whole[anchor], anchors.lengths[anchor])
        low[at] = high[at] = scores
        if children[anchor]:
            bounds[anchor] = low, high
        yield anchor, at, scores


class Stripe:
    """The rows of one stripe, by id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.all = Vectors(self.vectors)

    def positives(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, _, k: int) -> Iterator[tuple[int, None, np.ndarray, np.ndarray]]:
        """(anchor's place, None, ids, scores) of its best ``k`` of the stripe's rows of its label."""
        for label in np.unique(labels):
            own, those = np.nonzero(labels == label)[0], np.nonzero(self.labels == label)[0]
            if not len(those):
                continue
            these = self.ids[those]

            def choose(anchor: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                others = these != ids[own[anchor]]
                sure = low[others]
                least = np.partition(sure, len(sure) - k)[len(sure) - k] if len(sure) > k else -np.inf
                return np.nonzero(others & (high >= least))[0]

            for anchor, at, scores in walk(Vectors(vectors[own]), Vectors(self.vectors[those]), choose):
                best = np.lexsort((these[at], -scores))[:k]
                yield own[anchor], None, these[at[best]], scores[best]

    def negatives(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, positives: list, k: int, low: int, high: int) -> Iterator[tuple[int, dict, np.ndarray, np.ndarray]]:
        """(anchor's place, positive, ids, scores) of the best ``k`` of the
        stripe's rows of other labels in each positive's window."""
        windows = [[(-(-low * p["score"] // 100), high * p["score"] // 100) for p in found or []] for found in positives]

        def choose(anchor: int, least: np.ndarray, most: np.ndarray) -> np.ndarray:
            open_ = [w for w in windows[anchor] if w[0] <= w[1]]
            if not open_:
                return np.empty(0, np.int64)
            return np.nonzero((most >= min(a for a, _ in open_)) & (least <= max(b for _, b in open_)) & (self.labels != labels[anchor]))[0]

        for anchor, at, scores in walk(Vectors(vectors), self.all, choose):
            order = np.argsort(-scores, kind="stable")  # rows are by id: ties by smaller id
            falling = -scores[order]
            for positive, (a, b) in zip(positives[anchor] or [], windows[anchor]):
                start, end = np.searchsorted(falling, -b, "left"), np.searchsorted(falling, -a, "right")
                best = order[start : min(end, start + k)]
                if len(best):
                    yield anchor, positive, self.ids[at[best]], scores[best]


OUT = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])


def _meet(method: str, block: int, **named) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reads rows by stripe and dimension, a stripe's rows before the anchors."""

    def columns(runs: list[pa.RecordBatch], dim: int):
        table = pa.Table.from_batches(runs)
        flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
        return table["id"].to_numpy(), np.array(table["label"].to_pylist(), object).astype(str), flat.reshape(table.num_rows, dim), table["positives"]

    def results(stripe: Stripe | None, runs: list[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
        if stripe is None or not runs:
            return
        ids, labels, vectors, positives = columns(runs, dim)
        out: list[list] = [[], [], [], [], []]
        for anchor, positive, found, scores in getattr(stripe, method)(ids, labels, vectors, positives.to_pylist(), **named):
            n = len(found)
            for column, values in zip(out, ([ids[anchor]] * n, [positive and positive["id"]] * n, [positive and positive["score"]] * n, found.tolist(), scores.tolist())):
                column += values
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=OUT)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, stripe, rows, asked = None, None, [], []
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("dim", "stripe", "asked")])
            cuts = [0, *(np.nonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0))[0] + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                dim, number, anchors = marks[:, a].tolist()
                if (dim, number) != key:
                    yield from results(stripe, asked, key[0] if key else 0)
                    key, stripe, rows, asked = (dim, number), None, [], []
                if not anchors:
                    rows.append(batch.slice(a, b - a))
                    continue
                if rows:
                    stripe, rows = Stripe(*columns(rows, dim)[:3]), []
                for start in range(a, b, block):  # a stripe without rows of this dimension has nothing for the anchors
                    asked.append(batch.slice(start, min(block, b - start)))
                    if sum(r.num_rows for r in asked) >= block:
                        yield from results(stripe, asked, dim)
                        asked = []
        yield from results(stripe, asked, key[0] if key else 0)

    return read


def mine(
    df: DataFrame,
    anchors: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    stripe: int = STRIPE,
    block: int = BLOCK,
) -> DataFrame:
    """For every anchor (row of ``df`` where ``anchors`` holds) and each of its
    first ``positives`` rows of the same label, the first ``negatives`` rows of
    other labels that satisfy ``low * positive_score <= 100 * negative_score
    <= high * positive_score``: ``anchor_id``, ``positive_id``, ``rank`` (from
    1), ``negative_id``, ``positive_score``, ``negative_score``.

    A component x counts as floor(scale * x); scores are inner products with
    the anchor, exact.  Higher scores come first, ties by the smaller id.
    Rows with a null id, label or vector, or a null or non-finite component,
    take no part; rows of other dimensions than the anchor's are none of its
    positives or negatives.  A zero or empty vector scores 0.  Of rows that
    share an id, exactly repeated ones included, the one of the smallest label
    and vector counts.  A positive of negative score has an empty window.
    Components or scores beyond 64 bits are an error.  Other columns are not
    read.  An empty table gives an empty result.
    """
    rows = prepared(df, anchors, label, id_col, vector_col, scale)
    stripes = max(1, -(-rows.count() // stripe))
    dealt = rows.withColumns({"dim": F.size("vector"), "stripe": F.pmod(F.xxhash64("id"), F.lit(stripes)).cast("int"), "asked": F.lit(0)})
    every = dealt.where("anchor").withColumns({"stripe": F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))), "asked": F.lit(1)})
    names = ["dim", "stripe", "asked", "label", "id", "vector", "positives"]
    nothing = F.lit(None).cast("array<struct<id:bigint,score:bigint>>")

    def meet(asked: DataFrame, method: str, **named) -> DataFrame:
        both = dealt.withColumn("positives", nothing).select(names).unionByName(asked.select(names))
        there = both.repartitionById(stripes, F.col("stripe")).sortWithinPartitions(*names[:5])
        return there.mapInArrow(_meet(method, block, **named), "anchor_id long, positive_id long, positive_score long, id long, score long")

    found = meet(every.withColumn("positives", nothing), "positives", k=positives)
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    best = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= positives)
    of_anchor = materialize(best.groupBy("anchor_id").agg(F.collect_list(F.struct("id", "score")).alias("positives")), "negatives-positives")  # a few each
    asked = every.join(of_anchor, every["id"] == of_anchor["anchor_id"])
    held = meet(asked, "negatives", k=negatives, low=low, high=high)
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    ranked = held.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

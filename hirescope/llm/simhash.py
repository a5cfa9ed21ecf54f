"""SimHash near-duplicates by tiled exact comparison.

Every distinct fingerprint is compared with every other one exactly: the
fingerprints are range-sorted by the population counts of their quarters and
bytes and cut into tiles; a pair of tiles is skipped only when their population
counts alone prove that no two members are within the radius.  Inside a tile
pair, numpy exclusive-or and bit counts run over sub-tiles under the same
test, and the links found are reduced to a spanning forest, so a dense cloud
of near copies emits fewer links than it has members.

Work is spread by tile pair (no hashing into bands, so no hot band): copies
share one fingerprint and are one member.  Tiles, links and components stay
distributed; only the number of rounds of the component search depends on the
driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirescope.llm.common import materialize
from hirescope.llm.components import connected_components

#: words of a shingle and largest distance in bits of two linked fingerprints
SHINGLE_WORDS = 4
RADIUS = 4
#: fingerprints of a tile (one side of a task's comparison) and of a sub-tile
TILE = 32_768
SUB_TILE = 256
SEED = 42
#: shingles whose bits are counted at once
BIT_BLOCK = 65_536


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of one text, as an unsigned number.

    Words are split at space and U+0009 to U+000D, A-Z lower-cased; shingles
    of ``words`` words (the whole sequence if shorter) count with repeats; no
    words give 0.
    """
    import xxhash

    tokens = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not tokens:
        return 0
    line, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    if len(tokens) <= words:
        hashes = np.array([digest(line, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[: 1 - words].tolist(), ends[words - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BIT_BLOCK):
        part = hashes[at : at + BIT_BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_cols: Sequence[str], text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``id_cols`` and ``fingerprint`` (the 64 bits as a long) of every row."""
    ids = list(id_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(text.as_py(), words) for text in batch.column(len(ids))], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints.view(np.int64))], [*ids, "fingerprint"])

    schema = T.StructType([*(df.schema[c] for c in ids), T.StructField("fingerprint", T.LongType())])
    return df.select(*ids, F.col(text_col).alias("__text")).mapInArrow(run, schema)


def _counts(prints: np.ndarray) -> np.ndarray:
    """Population counts of the four quarters, then of the eight bytes."""
    return np.hstack([np.bitwise_count(np.ascontiguousarray(prints).view(kind).reshape(len(prints), -1)) for kind in (np.uint16, np.uint8)]).astype(np.int16)


def _gap(low_a, high_a, low_b, high_b):
    """Least distance in bits that the ranges of the counts allow."""
    apart = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return np.maximum(apart[..., :4].sum(-1), apart[..., 4:].sum(-1))


def _link(a: np.ndarray, b: np.ndarray | None, radius: int, sub: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (indices u, v into a then b) of the links between ``a``
    and ``b``, or within ``a`` if ``b`` is None."""
    nodes = a if b is None else np.concatenate([a, b])
    shift = 0 if b is None else len(a)
    other = a if b is None else b

    def boxes(x):
        cuts, counts = np.arange(0, len(x), sub), _counts(x)
        return np.minimum.reduceat(counts, cuts), np.maximum.reduceat(counts, cuts)

    (low_a, high_a), (low_b, high_b) = boxes(a), boxes(other)
    parent = np.arange(len(nodes))
    for s in range(len(low_a)):
        left = a[s * sub : (s + 1) * sub]
        near = np.nonzero(_gap(low_a[s], high_a[s], low_b, high_b) <= radius)[0]
        for t in near[near >= s] if b is None else near:
            right = other[t * sub : (t + 1) * sub]
            hits = np.bitwise_count(left[:, None] ^ right[None, :]) <= radius
            if b is None and s == t:
                hits = np.triu(hits, 1)
            i, j = np.nonzero(hits)
            if not len(i):
                continue
            x, y = parent[i + s * sub], parent[j + t * sub + shift]
            for p, q in np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1)[x != y], axis=0).tolist():
                while parent[p] != p:
                    p = parent[p]
                while parent[q] != q:
                    q = parent[q]
                if p != q:
                    parent[max(p, q)] = min(p, q)
            while (flat := parent[parent]).tobytes() != parent.tobytes():
                parent = flat
    u = np.nonzero(parent != np.arange(len(nodes)))[0]
    return u, parent[u]


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE, sub: int = SUB_TILE) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of distinct
    ``fingerprint`` values within ``radius`` bits."""
    pop = lambda shift, mask: F.bit_count(F.shiftrightunsigned("fingerprint", shift).bitwiseAND(F.lit(mask)))
    order = [pop(s, 0xFFFF) for s in (0, 16, 32, 48)] + [pop(s, 0xFF) for s in (0, 16, 32, 48)]
    distinct = prints.select("fingerprint").where("fingerprint is not null").distinct()
    parts = max(1, int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = [f"__k{i}" for i in range(len(order))]
    ranged = distinct.select("fingerprint", *(o.alias(k) for o, k in zip(order, keys))).repartitionByRange(parts, *keys, "fingerprint").sortWithinPartitions(*keys, "fingerprint")
    n_counts = 12

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, held = TaskContext.get().partitionId() << 32, np.empty(0, np.int64)

        def row(values, at):
            counts = _counts(values)
            return pa.RecordBatch.from_pylist([{"tile": base + at, "low": counts.min(0).tolist(), "high": counts.max(0).tolist(), "prints": values.tobytes()}], schema=arrow)

        at = 0
        for batch in batches:
            held = np.concatenate([held, batch.column(0).to_numpy()])
            while len(held) >= tile:
                yield row(held[:tile], at)
                held, at = held[tile:], at + 1
        if len(held):
            yield row(held, at)

    arrow = pa.schema([("tile", pa.int64()), ("low", pa.list_(pa.int32())), ("high", pa.list_(pa.int32())), ("prints", pa.binary())])
    tiles = materialize(ranged.mapInArrow(cut, "tile long, low array<int>, high array<int>, prints binary"), "simhash-tiles")

    # Pairs of tiles whose counts allow a link: they share a value of the first quarter's count
    # (one side widened by the radius), and their ranges are no further apart than the radius.
    boxes = tiles.select("tile", "low", "high")
    a = boxes.select(F.col("tile").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"), F.explode(F.sequence(F.col("low")[0] - radius, F.col("high")[0] + radius)).alias("q"))
    b = boxes.select(F.col("tile").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.explode(F.sequence(F.col("low")[0], F.col("high")[0])).alias("q"))
    apart = [F.greatest(F.lit(0), F.col("low_a")[i] - F.col("high_b")[i], F.col("low_b")[i] - F.col("high_a")[i]) for i in range(n_counts)]
    near = (sum(apart[1:4], apart[0]) <= radius) & (sum(apart[5:], apart[4]) <= radius)
    pairs = a.join(b, "q").where((F.col("a") <= F.col("b")) & near).select("a", "b").distinct()
    members = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile")).join(tiles.select("tile", "prints"), "tile")

    def compare(table: pa.Table) -> pa.Table:
        rows = {r["tile"]: np.frombuffer(r["prints"], np.uint64) for r in table.to_pylist()}
        first, second = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        x, y = rows[first], (None if first == second else rows[second])
        nodes = (x if y is None else np.concatenate([x, y])).view(np.int64)
        u, v = _link(x, y, radius, sub)
        return pa.table({"u": nodes[u], "v": nodes[v]})

    # written: what follows reads the links more than once
    return materialize(members.groupBy("a", "b").applyInArrow(compare, "u long, v long"), "simhash-links")


def near_duplicates(df: DataFrame, id_cols: Sequence[str] = ("doc_id",), text_col: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``id_cols``, ``fingerprint`` (long) and ``representative``, a struct of
    the ids of the smallest row reachable over links of at most ``radius`` bits
    (ids in the order given, nulls last).

    Repeated rows are linked like other copies.  Null and empty texts and
    texts of white space only have fingerprint 0 and are linked to each other
    and to any fingerprint near 0.  Other columns of ``df`` are not read.  An
    empty table gives an empty result.
    """
    ids = list(id_cols)
    prints = materialize(fingerprints(df, ids, text_col, words), "simhash-prints")
    rank = F.struct(*(x for c in ids for x in (F.col(c).isNull().alias(f"{c}_is_null"), F.col(c).alias(c))))
    classes = prints.groupBy("fingerprint").agg(F.min(rank).alias("first"))
    roots = connected_components(links(prints, radius, tile), "simhash-components")
    rooted = classes.join(roots, classes["fingerprint"] == roots["node"], "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("first"))
    labels = materialize(rooted.select("fingerprint", "root").join(lowest, "root").select("fingerprint", F.struct(*(F.col("first")[c].alias(c) for c in ids)).alias("representative")), "simhash-labels")
    return prints.join(labels, "fingerprint").select(*ids, "fingerprint", "representative")

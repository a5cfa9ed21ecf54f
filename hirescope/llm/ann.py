"""Approximate nearest neighbours by collision counting.

Nearness is the largest inner product.  A vector is extended by one component
that makes all vectors of its block equally long; a query, scaled to that
length and extended by 0, is then nearest to the vectors of largest inner
product.  Every block of vectors keeps one sorted array for each random
projection.  A query opens a window around its own projection in each array,
all windows of one width (virtual rehashing: no array is rebuilt); a vector
that stands in enough windows is a candidate.  The width is the least of a
fine scale that gives enough candidates, whatever queries went before, and
every candidate is verified by its exact inner product in double precision.

Blocks are cut from a range sort by length of the vectors, so the extension
is small within a block.  A task indexes its block once and lets all queries
pass, in blocks of their own; it returns the best few of each query, and a
final aggregation merges them.  Any vector is indexed; memory is bounded by the two block sizes, and
copies of one vector fill blocks like other vectors do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import materialize

NEAREST = 20
#: projections, and the share of windows that makes a vector a candidate
PROJECTIONS = 160
COLLIDE_SHARE = 0.6
#: candidates wanted: this share of the block and a multiple of the results
CANDIDATE_SHARE = 0.14
CANDIDATE_MULTIPLE = 6
#: places of a cell, and queries that are counted together
CELL = 64
TOGETHER = 256
#: the scale of half widths of windows (vectors have length 1): the first and their growth
WIDTH = 0.05
GROWTH = 1.05
#: where the search on this scale begins (it ends at the same step from anywhere)
START = 48
#: vectors of a block (places are 16-bit numbers) and queries of a block
BLOCK = 8192
QUERY_BLOCK = 2048
SEED = 20


def _projections(dim: int, m: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((m, dim + 1))


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _packed(df: DataFrame, size: int, order: list[str], name: str) -> DataFrame:
    """Rows (block, dim, ids, vectors) of at most ``size`` vectors of one
    dimension, cut from the range sort by ``order``."""
    parts = max(1, -(-df.count() // size))
    # the number of blocks follows their size, whatever number of partitions the sort comes to
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "vector").coalesce(parts)
    arrow = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        rows: list[np.ndarray] = []

        def block():
            out = {"block": number, "dim": len(rows[0]), "ids": np.array(ids, np.int64).tobytes(), "vectors": np.concatenate(rows).tobytes()}
            ids.clear(), rows.clear()
            return pa.RecordBatch.from_pylist([out], schema=arrow)

        for batch in batches:
            lists = batch.column(1)
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            for i, a, b in zip(batch.column(0).to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                if rows and (len(rows) == size or len(rows[0]) != b - a):
                    yield block()
                    number += 1
                ids.append(i)
                rows.append(flat[a:b])
        if rows:
            yield block()

    return materialize(ranged.mapInArrow(cut, "block long, dim int, ids binary, vectors binary"), name)


class SortedBlock:
    """One block of vectors with its sorted arrays, one per projection.

    Collisions of many queries are counted at once.  Every array keeps, for
    each cell of ``CELL`` places, one bit a vector that tells whether the
    vector stands before the cell; two of them differ in the vectors of a
    window (whole cells).  Counters of all vectors are kept as bits of equal
    weight, so one operation counts 64 vectors.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, m: int = PROJECTIONS):
        self.ids, self.vectors, self.columns = ids, vectors, np.ascontiguousarray(vectors.T)
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        self.longest = longest = lengths.max()
        extended = np.hstack([vectors / longest, np.sqrt(np.maximum(0.0, 1 - (lengths / longest) ** 2))[:, None]])
        self.lines = _projections(vectors.shape[1], m)
        projected = self.lines @ extended.T
        order = np.argsort(projected, axis=1)
        self.values = np.take_along_axis(projected, order, axis=1)
        self.order = order.astype(np.uint16).ravel()
        places = np.empty(order.shape, np.uint16)  # where each vector stands in each sorted array
        np.put_along_axis(places, order, np.arange(len(ids), dtype=np.uint16)[None, :], axis=1)
        edges = np.arange(-(-len(ids) // CELL) + 1)[:, None] * CELL
        width = -(-len(ids) // 64) * 64
        self.before = []
        for own in places:
            bits = np.zeros((len(edges), width), bool)
            bits[:, : len(ids)] = own < edges
            self.before.append(np.packbits(bits, axis=1, bitorder="little").view(np.uint64))
        #: place on the scale of widths where the queries before ended
        self.step = START

    def _window(self, at: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of each query's window in each array, (arrays, queries)."""
        width = WIDTH * GROWTH**steps
        low = np.array([v.searchsorted(x, "left") for v, x in zip(self.values, (at - width[:, None]).T)])
        return low, np.array([v.searchsorted(x, "right") for v, x in zip(self.values, (at + width[:, None]).T)])

    def _cells(self, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
        """For each query the windows of whole cells that each vector stands
        in: one row of bits for each power of two."""
        waiting: list[list[np.ndarray]] = [[] for _ in range(len(self.values).bit_length() + 2)]
        for before, a, b in zip(self.before, low // CELL, -(-high // CELL)):
            waiting[0].append(before[a] ^ before[b])
            for weight, same in enumerate(waiting):  # three bits of one weight are one, and one of the next
                if len(same) < 3:
                    break
                x, y, z = same
                either = x ^ y
                waiting[weight + 1].append((x & y) | (either & z))
                waiting[weight] = [either ^ z]
        planes = []
        for weight, same in enumerate(waiting[:-1]):
            while len(same) > 1:
                x, y = same.pop(), same.pop()
                waiting[weight + 1].append(x & y)
                same.append(x ^ y)
            planes.append(same[0] if same else np.zeros((low.shape[1], self.before[0].shape[1]), np.uint64))
        return planes

    def _reached(self, planes: list[np.ndarray], need: int) -> np.ndarray:
        """Vectors, as bits, whose number is at least ``need``."""
        more, equal = np.zeros_like(planes[0]), ~np.zeros_like(planes[0])
        for weight in reversed(range(len(planes))):
            plane = planes[weight]
            if need >> weight & 1:
                equal = equal & plane
            else:
                more, equal = more | (equal & plane), equal & ~plane
        return more | equal

    def _exact(self, low: np.ndarray, high: np.ndarray, planes: list[np.ndarray], need: int) -> np.ndarray:
        """Positions of the vectors that stand in enough of one query's
        windows: what whole cells hold beside the windows is taken off."""
        n = len(self.ids)
        counts = np.zeros(n, np.int64)
        for weight, plane in enumerate(planes):
            counts += np.unpackbits(plane.view(np.uint8), count=n, bitorder="little").astype(np.int64) << weight
        starts, ends = np.concatenate([low // CELL * CELL, high]), np.concatenate([low, np.minimum(n, -(-high // CELL) * CELL)])
        sizes = ends - starts
        starts += np.tile(np.arange(len(low)) * n, 2)  # the arrays lie one after the other
        beside = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return np.flatnonzero(counts - np.bincount(self.order[beside], minlength=n) >= need)

    def candidates_of(self, at: np.ndarray, wanted: int) -> list[np.ndarray]:
        """Positions of the vectors that collide with each query, whose
        projections are the rows of ``at``, in enough windows of the least
        width that gives ``wanted``.

        Counts grow with the width: from where the queries before ended,
        strides that double find a step of too few and one of enough, and
        halving the steps between them the first of enough.  Whole cells may
        hold a few vectors too many, so the last step is counted exactly, and
        the next one if that leaves too few."""
        need = max(1, int(np.ceil(COLLIDE_SHARE * len(self.values))))
        n = len(at)
        few, enough = np.full(n, -1), np.full(n, -1)
        step, stride = np.full(n, self.step), np.ones(n, int)
        out: list[np.ndarray] = [np.empty(0, int)] * n
        open_ = np.arange(n)
        while len(open_):
            low, high = self._window(at[open_], step[open_])
            planes = self._cells(low, high)
            counts = np.bitwise_count(self._reached(planes, need)).sum(axis=1, dtype=np.int64)
            left = []
            for row, i in enumerate(open_):
                if counts[row] >= wanted and step[i] == few[i] + 1:
                    found = self._exact(low[:, row], high[:, row], [p[row] for p in planes], need)
                    if len(found) >= wanted:
                        out[i], enough[i] = found, step[i]
                        continue
                    few[i], enough[i], stride[i] = step[i], -1, 1
                    step[i] += 1
                elif counts[row] >= wanted:
                    enough[i] = step[i]
                    if few[i] < 0:
                        step[i], stride[i] = max(0, enough[i] - stride[i]), 2 * stride[i]
                    else:
                        step[i] = few[i] + max(1, (enough[i] - few[i]) // 2)
                else:
                    few[i] = step[i]
                    if enough[i] < 0:
                        step[i], stride[i] = few[i] + stride[i], 2 * stride[i]
                    else:
                        step[i] = few[i] + max(1, (enough[i] - few[i]) // 2)
                left.append(i)
            open_ = np.array(left, int)
        self.step = int(np.median(enough))
        return out

    def candidates(self, at: np.ndarray, wanted: int) -> np.ndarray:
        return self.candidates_of(at[None, :], wanted)[0]

    def search(self, query_ids: list[int], queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and exact inner products of the best ``k`` candidates of each query."""
        n = len(self.ids)
        wanted = min(n, CANDIDATE_MULTIPLE * k + int(CANDIDATE_SHARE * n))
        lengths = np.sqrt((queries * queries).sum(axis=1))
        at = np.hstack([queries / lengths[:, None], np.zeros((len(queries), 1))]) @ self.lines.T
        for start in range(0, len(queries), TOGETHER):
            for i, found in enumerate(self.candidates_of(at[start : start + TOGETHER], wanted), start):
                found = found[self.ids[found] != query_ids[i]]
                if len(found) > k:  # what cannot be among the best, whatever the order of summation
                    near = self.vectors[found] @ queries[i]
                    found = found[near >= np.partition(near, len(near) - k)[len(near) - k] - 1e-9 * lengths[i] * self.longest]
                scores = np.zeros(len(found))
                for column, x in zip(self.columns, queries[i]):  # one order of summation, whatever the block
                    scores += column[found] * x
                ids = self.ids[found]
                best = np.lexsort((ids, -scores))[:k]
                yield ids[best], scores[best]


def search(df: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k``
    nearest rows found for every row of ``df`` where ``queries`` holds.

    Vectors that are null, zero or hold a null or non-finite component take no
    part, as query or candidate; nor do rows with a null id.  A row is no
    candidate for its own id.  Exactly repeated rows count once; if rows share
    an id, the smallest vector is the query.  Ties go to the smaller id.
    Vectors of other dimensions than the query's are no candidates.  With
    fewer than ``k`` candidates all are returned.  Other columns are not read.
    An empty table gives an empty result.
    """
    if not 0 < block < 1 << 16:
        raise ValueError("a block holds 1 to 65535 vectors")
    rows = df.where(F.col(id_col).isNotNull() & _usable(F.col(vector_col))).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), queries.alias("__query"))
    rows = materialize(rows.distinct(), "ann-vectors")
    length = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    index = _packed(rows.select("id", "vector", F.size("vector").alias("dim"), length.alias("length")), block, ["dim", "length", "id"], "ann-index")
    asked = rows.where("__query").groupBy("id").agg(F.min("vector").alias("vector"))
    packed = _packed(asked.withColumn("dim", F.size("vector")), query_block, ["dim", "id"], "ann-queries")
    # every block of queries meets every block of vectors of its dimension
    meetings = index.select("block", "dim").join(packed.select(F.col("block").alias("asked"), "dim"), "dim").select("block", "asked")
    # a block of vectors is indexed once, then all blocks of queries come by
    vectors = index.select("block", F.lit(0).cast("long").alias("asked"), F.lit(False).alias("query"), "dim", "ids", "vectors")
    asked = packed.withColumnRenamed("block", "asked").join(meetings, "asked").select("block", "asked", F.lit(True).alias("query"), packed["dim"], "ids", "vectors")
    together = vectors.unionByName(asked).repartition(max(1, index.count()), "block").sortWithinPartitions("block", "query", "asked")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, waiting = None, []  # blocks of queries, which may be small, are searched together

        def searched() -> Iterator[pa.RecordBatch]:
            if not waiting:
                return
            ids, matrix = np.concatenate([i for i, _ in waiting]), np.concatenate([m for _, m in waiting])
            waiting.clear()
            found = [[{"away": -s, "vec_id": v} for v, s in zip(best.tolist(), scores.tolist())] for best, scores in own.search(ids.tolist(), matrix, k)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.struct([("away", pa.float64()), ("vec_id", pa.int64())])))], ["query_id", "found"])

        for batch in batches:
            for row in range(batch.num_rows):
                query, dim, ids, data = (batch.column(c)[row] for c in ("query", "dim", "ids", "vectors"))
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                matrix = np.frombuffer(data.as_buffer(), np.float64).reshape(len(ids), dim.as_py())
                if not query.as_py():
                    yield from searched()
                    own = SortedBlock(ids, matrix)
                    continue
                waiting.append((ids, matrix))
                if sum(len(i) for i, _ in waiting) >= TOGETHER:
                    yield from searched()
        yield from searched()

    met = together.mapInArrow(meet, "query_id long, found array<struct<away:double,vec_id:long>>")
    best = met.groupBy("query_id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, k).alias("found"))
    return best.select("query_id", F.posexplode("found").alias("rank", "x")).select("query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", (-F.col("x.away")).alias("score"))

"""Substring deduplication by counted window hashes.

Every run of ``window`` consecutive words of a document is hashed by
Rabin-Karp: words are hashed to 64 bits, and a window's hash is the difference
of two prefix sums of word hashes times powers of an odd base, shifted back to
the window's start.  Spark counts the hashes of all windows of all documents;
windows whose hash starts at two or more places, in one document or in
several, are repeated, and overlapping repeated windows merge into maximal
removal intervals.

How the count is laid out: documents are dealt to chunks of bounded size.  A
chunk sends each distinct hash once (a passage shared by a third of all
documents arrives once per chunk, not once per document), sorted and
delta-coded, to the bucket of its leading bits; a bucket sorts what it gets
and answers every chunk with one bit per hash; the chunk meets its answers
again and marks its words.  The texts are shuffled once (both uses read the
same exchange), hashes cost about six bytes a window, answers one bit.

Two different windows share a hash with probability 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 35
#: text bytes of a chunk, the unit that one task holds at a time
CHUNK_BYTES = 4 << 20
#: distinct hashes that a bucket is sized for
BUCKET_HASHES = 2 << 20
#: bytes of one text that are split into words at once
SLICE = 1 << 20
#: odd base of the polynomial (arithmetic is modulo 2**64) and its inverse
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
SPACES = b" \t\n\x0b\x0c\r"


def word_slices(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded slice at a time."""
    at = 0
    while at < len(data):
        end = min(len(data), at + SLICE)
        while end < len(data) and data[end] not in SPACES:
            end += 1
        yield data[at:end].split()
        at = end


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


class Windows:
    """Window hashes of texts; power tables grow to the longest text seen."""

    def __init__(self, window: int):
        self.window, self._up, self._down = window, _powers(BASE, 0), _powers(BASE_INVERSE, 0)

    def hashes(self, data: bytes) -> tuple[int, np.ndarray]:
        """Number of words, and the hash of the window at each start."""
        import xxhash

        digest = xxhash.xxh64_intdigest
        parts = [np.fromiter(map(digest, words), np.uint64, len(words)) for words in word_slices(data)]
        words = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        n, k = len(words), self.window
        if n < k:
            return n, np.empty(0, np.uint64)
        if n > len(self._up):
            self._up, self._down = _powers(BASE, 2 * n), _powers(BASE_INVERSE, 2 * n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self._up[:n], dtype=np.uint64)])
        return n, (sums[k:] - sums[:-k]) * self._down[: n - k + 1]


def pack(hashes: np.ndarray) -> bytes:
    """Sorted hashes as differences, byte planes apart (compresses well)."""
    return np.diff(hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _bounds(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket's hashes begin among sorted hashes, and the end."""
    if not bits:
        return np.array([0, len(hashes)])
    firsts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(hashes, firsts), len(hashes))


def _among(hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which ``hashes`` are among the sorted ``wanted`` ones."""
    if not len(wanted):
        return np.zeros(len(hashes), bool)
    return wanted[np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)] == hashes


def _texts(column) -> Iterator[bytes]:
    for value in column:
        yield (value.as_py() or "").encode()


def covered(repeated: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of ``n`` words a repeated window covers."""
    change = np.zeros(n + 1, np.int32)
    starts = np.nonzero(repeated)[0]
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change[:n]) > 0


def remove_repeats(df: DataFrame, columns: Sequence[str] = ("doc_id",), text_col: str = "text", window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, bucket_hashes: int = BUCKET_HASHES) -> DataFrame:
    """``columns`` of every row with ``n_words``, ``n_removed``, ``intervals``
    (array of struct start, end: removed word positions, end exclusive, maximal
    and in order) and ``kept`` (the words left, joined by one space).

    Words are what white space (space, U+0009 to U+000D) separates, unchanged.
    Windows are judged on the input: all copies of a repeated window go.  Null,
    empty and blank texts have no words and an empty ``kept``; texts shorter
    than the window are kept.  Repeated rows are copies of each other.  Columns
    not named are not read; naming one of the result's is an error.  An empty
    table gives an empty result.
    """
    results = ["n_words", "n_removed", "intervals", "kept"]
    columns = list(columns)
    if set(columns) & set(results):
        raise ValueError(f"columns must not hold {sorted(set(columns) & set(results))}")
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    bits = max(0, (size // 6 // bucket_hashes)).bit_length()
    carried = [F.col(c) for c in columns if c != text_col]  # the text itself travels once
    base = df.select(F.pmod(F.xxhash64(*dict.fromkeys([text_col, *columns])), F.lit(chunks)).alias("__chunk"), F.col(text_col).alias("__text"), *carried)

    def emit(table: pa.Table) -> pa.Table:
        windows = Windows(window)
        own = [windows.hashes(data)[1] for data in _texts(table.column("__text"))]
        hashes, counts = np.unique(np.concatenate(own), return_counts=True)
        cuts = _bounds(hashes, bits)
        full = np.nonzero(np.diff(cuts))[0].tolist()
        return pa.table(
            {
                "bucket": pa.array(full, pa.int64()),
                "chunk": pa.array([table.column("__chunk")[0].as_py()] * len(full), pa.int64()),
                "hashes": pa.array([pack(hashes[cuts[b] : cuts[b + 1]]) for b in full], pa.binary()),
                "twice": pa.array([np.packbits(counts[cuts[b] : cuts[b + 1]] > 1).tobytes() for b in full], pa.binary()),
            }
        )

    def count(table: pa.Table) -> pa.Table:
        own = [unpack(h.as_py()) for h in table.column("hashes")]
        merged = np.sort(np.concatenate(own))
        shared = np.unique(merged[1:][merged[1:] == merged[:-1]])
        answers = []
        for hashes, twice in zip(own, table.column("twice")):
            flags = np.unpackbits(np.frombuffer(twice.as_py(), np.uint8), count=len(hashes)).astype(bool)
            flags |= _among(hashes, shared)
            answers.append(np.packbits(flags).tobytes() if flags.any() else None)
        found = [i for i, a in enumerate(answers) if a is not None]
        return pa.table({"chunk": table.column("chunk").take(found).combine_chunks(), "bucket": table.column("bucket").take(found).combine_chunks(), "flags": pa.array([answers[i] for i in found], pa.binary())})

    item = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def mark(table: pa.Table, answers: pa.Table) -> pa.Table:
        windows = Windows(window)
        own = [windows.hashes(data) for data in _texts(table.column("__text"))]
        hashes = np.unique(np.concatenate([h for _, h in own])) if own else np.empty(0, np.uint64)
        cuts, flags = _bounds(hashes, bits), np.zeros(len(hashes), bool)
        for bucket, packed in zip(answers.column("bucket").to_pylist(), answers.column("flags").to_pylist()):
            flags[cuts[bucket] : cuts[bucket + 1]] = np.unpackbits(np.frombuffer(packed, np.uint8), count=cuts[bucket + 1] - cuts[bucket])
        repeated, out = hashes[flags], {r: [] for r in results}
        for data, (n, h) in zip(_texts(table.column("__text")), own):
            gone = covered(_among(h, repeated), n, window) if len(repeated) else np.zeros(n, bool)
            edges = np.nonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))[0].reshape(-1, 2)
            kept, at = [], 0
            for words in word_slices(data):
                stay = ~gone[at : at + len(words)]
                kept += words if stay.all() else [w for w, s in zip(words, stay.tolist()) if s]
                at += len(words)
            out["n_words"].append(n)
            out["n_removed"].append(int(gone.sum()))
            out["intervals"].append([{"start": a, "end": b} for a, b in edges.tolist()])
            out["kept"].append(b" ".join(kept).decode())
        kinds = [pa.int64(), pa.int64(), pa.list_(item), pa.string()]
        return pa.table([table.column("__text" if c == text_col else c) for c in columns] + [pa.array(out[r], k) for r, k in zip(results, kinds)], [*columns, *results])

    schema = T.StructType(
        [
            *(df.schema[c] for c in columns),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("intervals", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
            T.StructField("kept", T.StringType()),
        ]
    )
    sent = base.groupBy("__chunk").applyInArrow(emit, "bucket long, chunk long, hashes binary, twice binary")
    answers = sent.groupBy("bucket").applyInArrow(count, "chunk long, bucket long, flags binary")
    return base.groupBy("__chunk").cogroup(answers.groupBy("chunk")).applyInArrow(mark, schema)

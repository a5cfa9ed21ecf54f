"""Token counts of documents by a separator scan.

Flat token files hold nothing but ids: documents one after the other, each
closed by an end-of-document id, no index.  They are read in blocks of fixed
size that ignore document boundaries.  In every block numpy finds the
separators; documents that span blocks are stitched by a prefix scan over the
blocks' summaries (tokens, separators, place of the last separator).  The scan
has two levels, segments of blocks within a file and then the segments, so a
file of any length is spread over tasks; a summary holds one number a
document, never the tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hirescope.llm.common import materialize
from hirescope.llm.packing import _encoder

#: ids of a block, and blocks of a segment
BLOCK_TOKENS = 1 << 16
SEGMENT = 1 << 10
#: blocks of a file's range that one row names, and bytes that a task reads
RANGE = 64
TASK_BYTES = 128 << 20
DTYPE = "<u2"


def token_blocks(df: DataFrame, tokenizer_path: str, separator: int, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS, dtype: str = DTYPE) -> DataFrame:
    """The documents as flat token files, one a task, in blocks: ``file``,
    ``block``, ``data`` (ids) and ``docs``, the writer's list of the documents
    that it closed in the block."""
    width, arrow_id = np.dtype(dtype).itemsize, df.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, file, block = _encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        held, size, closed = [], 0, []  # parts of the open block, their ids, and where documents end
        kind = None

        def cut(n: int) -> pa.RecordBatch:
            nonlocal held, size, closed, block
            data = b"".join(held)
            own = [d for end, d in closed if end < n]
            row = pa.RecordBatch.from_arrays([pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([data[: n * width]], pa.binary()), pa.array([own], pa.list_(kind))], ["file", "block", "data", "docs"])
            held, size, closed, block = [data[n * width :]], size - n, [(end - n, d) for end, d in closed if end >= n], block + 1
            return row

        for batch in batches:
            kind = batch.column(0).type
            for doc, data in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1))):
                ids = np.frombuffer(data, "<u4")
                if len(ids) and ids.max() > np.iinfo(dtype).max:
                    raise ValueError(f"ids do not fit {dtype}")
                held.append(np.append(ids, separator).astype(dtype).tobytes())
                size += len(ids) + 1
                closed.append((size - 1, doc))
                while size >= block_tokens:
                    yield cut(block_tokens)
        if size:
            yield cut(size)

    schema = T.StructType([T.StructField("file", T.LongType()), T.StructField("block", T.LongType()), T.StructField("data", T.BinaryType()), T.StructField("docs", T.ArrayType(arrow_id))])
    return df.select(id_col, text_col).mapInArrow(run, schema)


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark names it, and the path in it."""
    scheme, _, rest = path.partition(":")
    return (fs.LocalFileSystem(), re.sub("^/+", "/", rest)) if scheme == "file" else fs.FileSystem.from_uri(quote(path, safe=":/@"))


def _reached(path: str) -> bool:
    try:
        system, name = _place(path)
        return system.get_file_info(name).type == fs.FileType.File
    except (OSError, ValueError, NotImplementedError):
        return False


def read_token_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, dtype: str = DTYPE) -> DataFrame:
    """Flat token files under ``path``, of any length, as blocks (``file``,
    ``block``, ``data``).

    Spark lists the files with their lengths; ranges of blocks are dealt to
    tasks, which read them a block at a time through pyarrow's file systems.
    Files of a store that pyarrow does not reach go whole through Spark's
    binary reader, which fails for files over 2 GB.
    """
    step = block_tokens * np.dtype(dtype).itemsize
    listed = spark.read.format("binaryFile").load(path)
    scheme = F.substring_index("path", ":", 1)
    found = listed.where("length > 0").groupBy(scheme.alias("scheme")).agg(F.min("path").alias("path"), F.sum("length").alias("bytes"), F.sum(F.ceil(F.col("length") / (RANGE * step))).alias("ranges")).collect()
    near = {r["scheme"]: r for r in found if _reached(r["path"])}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, length, first in zip(*(c.to_pylist() for c in batch.columns)):
                system, name = _place(file)
                with system.open_input_file(name) as source:
                    for block in range(first, min(first + RANGE, -(-length // step))):
                        part = source.read_at(min(step, length - block * step), block * step)
                        if len(part) != min(step, length - block * step):
                            raise OSError(f"{file} is shorter than the {length} bytes listed")
                        yield row(file, block, part)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_buffer()
                for block, at in enumerate(range(0, data.size, step)):
                    yield row(file, block, data.slice(at, min(step, data.size - at)).to_pybytes())

    def row(file: str, block: int, part: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block], pa.int64()), pa.array([part], pa.binary())], ["file", "block", "data"])

    schema = "file string, block long, data binary"
    far = listed.where(~scheme.isin(*near)).select("path", "content").mapInArrow(cut, schema)
    if not near:
        return far
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / step), F.lit(RANGE).cast("long")))
    ranges = listed.where((F.col("length") > 0) & scheme.isin(*near)).select("path", "length", first.alias("first"))
    total, n = sum(r["bytes"] for r in near.values()), sum(r["ranges"] for r in near.values())
    tasks = max(1, min(n, max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))))
    blocks = ranges.repartition(tasks).mapInArrow(read, schema)
    return blocks if len(near) == len(found) else blocks.unionByName(far)


def count_tokens(blocks: DataFrame, separator: int, id_col: str | None = None, dtype: str = DTYPE, segment: int = SEGMENT) -> DataFrame:
    """``file``, ``doc`` (number in the file, from 0), ``start`` (ids of the
    file before it), ``n_tokens`` (without the separator) of every document;
    ``id_col``, if given, is taken from the blocks' ``docs``.

    Blocks of a file are numbered in order; numbers may be missing where there
    are no ids.  Two separators in a row enclose an empty document.  What
    follows the last separator of a file is a document if it has ids.  Null
    and empty blocks hold no ids.  An empty table gives an empty result.
    """
    own = ["file", "block"] + (["docs"] if id_col else [])
    columns = [*own, "data"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, places = [], []
            for data in batch.column(len(own)):
                ids = np.frombuffer(data.as_buffer(), dtype) if data.is_valid else np.empty(0, dtype)
                n.append(len(ids))
                places.append(np.flatnonzero(ids == separator).astype(np.int32))
            ends = np.cumsum([0, *map(len, places)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *places])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64()), lists], [*own, "n", "places"])

    kinds = T.StructType([*(blocks.schema[c] for c in own), T.StructField("n", T.LongType()), T.StructField("places", T.ArrayType(T.IntegerType()))])
    found = materialize(blocks.select(*columns).mapInArrow(scan, kinds), "token-separators")

    # within a segment: ids, separators and place of the last separator before each block
    inside = Window.partitionBy("file", "segment").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    summary = found.select("file", "block", F.floor(F.col("block") / segment).alias("segment"), "n", F.size("places").alias("k"), F.get("places", F.size("places") - 1).alias("last"))
    near = summary.withColumns({"n0": zero(F.sum("n").over(inside)), "k0": zero(F.sum("k").over(inside))})
    near = near.withColumn("at", F.col("n0") + F.col("last")).withColumn("last0", F.max("at").over(inside))
    # and before each segment
    along = Window.partitionBy("file").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    whole = near.groupBy("file", "segment").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.max("at").alias("at"))
    far = whole.withColumns({"n1": zero(F.sum("n").over(along)), "k1": zero(F.sum("k").over(along))})
    far = far.withColumn("at", F.col("n1") + F.col("at")).withColumn("last1", F.max("at").over(along))
    stitched = near.select("file", "segment", "block", "n0", "k0", "last0").join(far.select("file", "segment", "n1", "k1", "last1"), ["file", "segment"])
    before = F.coalesce(F.col("n1") + F.col("last0"), F.col("last1"), F.lit(-1))
    bases = stitched.select("file", "block", (F.col("n0") + F.col("n1")).alias("base"), (F.col("k0") + F.col("k1")).alias("doc0"), before.alias("before"))

    zipped = F.arrays_zip("places", "docs") if id_col else F.arrays_zip("places")
    each = found.join(bases, ["file", "block"]).select("file", "base", "doc0", "before", "places", F.posexplode(zipped).alias("i", "x"))
    start = F.when(F.col("i") == 0, F.col("before") + 1).otherwise(F.col("base") + F.get("places", F.col("i") - 1) + 1)
    closed = each.select("file", (F.col("doc0") + F.col("i")).alias("doc"), start.alias("start"), (F.col("base") + F.col("x.places") - start).alias("n_tokens"), *([F.col("x.docs").alias(id_col)] if id_col else []))
    ends = whole.groupBy("file").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).join(far.groupBy("file").agg(F.max("at").alias("at")), "file")
    tail = F.col("n") - F.coalesce("at", F.lit(-1)) - 1
    nothing = [F.lit(None).cast(blocks.schema["docs"].dataType.elementType).alias(id_col)] if id_col else []
    open_ = ends.where(tail > 0).select("file", F.col("k").alias("doc"), (F.coalesce("at", F.lit(-1)) + 1).alias("start"), tail.alias("n_tokens"), *nothing)
    return closed.unionByName(open_)

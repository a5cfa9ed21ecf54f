"""Byte-level BPE by way of a sentencepiece model.

The rank file's vocabulary becomes a sentencepiece BPE model as it stands:
every byte is mapped to one printable character, a token is the piece spelled
by its mapped bytes, the piece's score is its negative rank, the piece's id is
its rank, and normalisation is the identity.  Merging the best-scored pair
first is then merging the lowest-ranked pair first.  Texts are cut by the
vocabulary's pattern, every pre-token is encoded separately, and decoding
looks the pieces' bytes up again.

Both directions are map-only: one pass, no shuffle, memory bounded by one
Arrow batch and a cache of fixed size.

Null or empty texts have no ids and decode to no bytes.  Repeated rows are
encoded alike; columns other than the two named ones are not read, so their
names cannot clash.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: characters that stand for the bytes 0 to 255 (none is a space of any kind)
BYTE_BASE = 0x100
#: Unicode White_Space, which is what the patterns' \s means
WHITE = "\t-\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: entries of a generation of a worker's encoded text chunks, and of its pre-tokens
CACHE_ENTRIES = 180_000
#: longer chunks are encoded but not kept
CACHE_CHARS = 40


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a ``.tiktoken`` file (base64, rank a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised sentencepiece BPE model of a rank vocabulary."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    by_rank = sorted(ranks.items(), key=lambda item: item[1])
    if [rank for _, rank in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every single byte must be in the vocabulary")
    model = proto.ModelProto()
    for token, rank in by_rank:
        model.pieces.add(piece="".join(chr(BYTE_BASE + b) for b in token), score=-float(rank), type=proto.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    trainer, normalizer = model.trainer_spec, model.normalizer_spec
    trainer.model_type = proto.TrainerSpec.BPE
    trainer.unk_id, trainer.bos_id, trainer.eos_id, trainer.pad_id = len(by_rank), -1, -1, -1
    normalizer.name = "identity"
    normalizer.add_dummy_prefix = normalizer.remove_extra_whitespaces = normalizer.escape_whitespaces = False
    return model.SerializeToString()


# A chunk is white space or a run without any, with the one space before it.
_CHUNKS = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: pieces of the texts on which a pattern is tried
_PROBES = ("a", "1", ".", "'s", " ", "\n", "\t", "\u3000", "\r\n")


def check_pattern(pattern: str) -> None:
    """Refuse a pattern whose matches run across the ends of chunks, tried on
    all texts of up to four probe pieces: texts are split into chunks first,
    which is right only where that changes no pre-token."""
    import regex

    find = regex.compile(pattern).findall
    for length in range(2, 5):
        for pieces in product(_PROBES, repeat=length):
            text = "".join(pieces)
            if find(text) != [p for chunk in _CHUNKS.findall(text) for p in find(chunk)]:
                raise ValueError(f"this pattern's pre-tokens depend on what stands around white space, as in {text!r}")


class Encoder:
    """Texts to id bytes (little-endian int32) with one sentencepiece model."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._pre_tokens = regex.compile(pattern).findall
        # supported patterns never match across a chunk's end, so a chunk has whole matches only
        self._chunks = _CHUNKS.findall
        self._mapping = {b: BYTE_BASE + b for b in range(256)}
        # kept chunks are of two generations: one met again moves to the younger, the older goes when that is full
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._tokens: dict[str, bytes] = {}

    def _encode_pre_tokens(self, pre_tokens: set[str]) -> dict[str, bytes]:
        known = {p: self._tokens[p] for p in pre_tokens if p in self._tokens}
        new = [p for p in pre_tokens if p not in known]
        mapped = [p.encode().decode("latin-1").translate(self._mapping) for p in new]
        fresh = {p: array("i", i).tobytes() for p, i in zip(new, self._model.encode(mapped, num_threads=1))}
        if len(self._tokens) > CACHE_ENTRIES:
            self._tokens.clear()
        self._tokens.update((p, i) for p, i in fresh.items() if len(p) <= CACHE_CHARS)
        return known | fresh

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks that are not in the younger generation; short ones go there."""
        found = {c: self._old[c] for c in chunks if c in self._old}
        parts = {c: self._pre_tokens(c) for c in chunks if c not in found}
        ids = self._encode_pre_tokens({p for pre_tokens in parts.values() for p in pre_tokens})
        found.update((c, b"".join([ids[p] for p in pre_tokens])) for c, pre_tokens in parts.items())
        self._young.update((c, i) for c, i in found.items() if len(c) <= CACHE_CHARS)
        return found

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(self._young) > CACHE_ENTRIES:
            self._old, self._young = self._young, {}
        chunks, young = self._chunks(text), self._young
        new = {c for c in chunks if c not in young}
        if new:
            found = self._learn(new)
            return b"".join([found[c] if c in found else young[c] for c in chunks])
        return b"".join([young[c] for c in chunks])


_ENCODERS: dict[int, Encoder] = {}


def encoder(model: bytes, pattern: str) -> Encoder:
    """This worker's encoder (kept from task to task with its cache)."""
    key = hash((model, pattern))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model, pattern)
    return _ENCODERS[key]


def _id_type(df: DataFrame, id_col: str) -> T.DataType:
    return df.schema[id_col].dataType


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``ids_col`` (array of int) for every row of ``df``.

    ``ranks_path`` is read on the driver; tasks get the serialised model.
    ``pattern`` must be one whose pre-tokens do not reach across white space
    but for the one space before them; others are refused.
    """
    check_pattern(pattern)
    model = sentencepiece_model(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model, pattern)
        for batch in batches:
            # texts are cut out one by one: only the encoded ids of the batch stay in memory
            parts = [enc.encode(text.as_py()) for text in batch.column(1)]
            offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts], dtype=np.int64)]).astype(np.int32)
            flat = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(parts))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), flat)], [id_col, ids_col])

    schema = T.StructType([T.StructField(id_col, _id_type(df, id_col)), T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    return df.select(id_col, text_col).mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` (an id column and ``ids_col``) with the decoded bytes added.

    A null list decodes to no bytes; an id outside the vocabulary is an error.
    """
    tokens = [t for t, _ in sorted(read_ranks(ranks_path).items(), key=lambda item: item[1])]
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(tokens, pa.binary())
        for batch in batches:
            lists = batch.column(columns.index(ids_col))
            ends = np.cumsum(np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
            pieces = vocabulary.take(lists.flatten())  # the pieces' bytes, one after the other
            _, piece_ends, data = pieces.buffers()
            starts = np.frombuffer(piece_ends, np.int32, len(pieces) + 1, pieces.offset * 4) if len(pieces) else np.zeros(1, np.int32)
            at = pa.py_buffer(starts[np.concatenate([[0], ends])].astype(np.int32))
            decoded = pa.Array.from_buffers(pa.binary(), len(lists), [None, at, data])
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*columns, bytes_col])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(bytes_col, T.BinaryType())]))


def digests(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of encoded and decoded rows."""
    return df.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

"""Packing documents into sequences by linear grouping.

Tokenised documents are cut into pieces of at most one sequence.  The packing
itself needs only how many pieces there are of each length, at most
``capacity`` numbers whatever the size of the corpus:

1. large lengths are sorted and cut into groups of equal cardinality; every
   member is rounded up to the longest of its group, which leaves few sizes;
2. configurations of these sizes are optimised: the largest size left is
   completed by the fullest possible sum of the other sizes left, and the
   configuration is used as often as its groups allow;
3. the actual lengths of each group are put back into its places;
4. small lengths go, longest first, each into the sequence it fits best.

The result is a plan, a list of runs of equal sequences, whose size is bounded
by ``capacity`` and the number of groups.  Spark then numbers the pieces of
every length (a length shared by very many pieces is numbered in salted
parts) and looks their places up in the plan.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hirescope.llm.common import materialize

CAPACITY = 2048
#: number of groups of equal cardinality
GROUPS = 1024
#: lengths of at most capacity / SMALL_PART are packed last, by best fit
SMALL_PART = 8
END_ID = 0
#: words of a generation whose ids a worker keeps, and the longest of them
CACHE_WORDS = 250_000
CACHE_CHARS = 40
#: characters of text that are encoded at once
SLICE = 1 << 22
#: new words that are encoded as one text
JOINED = 256
#: pieces of one length that are numbered in one part
PART_ROWS = 50_000


_LETTERS = f"A-Za-z{chr(0xC0)}-{chr(0xD6)}{chr(0xD8)}-{chr(0xF6)}{chr(0xF8)}-{chr(0x12F)}{chr(0x131)}-{chr(0x24F)}"
_SIGNS = "!-&(-/:-@\\[-`{-~"


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


class WordEncoder:
    """Ids of texts for a tokenizer whose pre-tokens never hold white space:
    words between spaces are encoded on their own and kept.

    Of words of Latin letters (but U+0130, whose lower case ends in a mark),
    ASCII digits and ASCII signs (but the apostrophe, which can join letters)
    it is known into how many pre-tokens they fall.  New ones are encoded many
    at a time as one text: the last id of a pre-token, and no other, is one
    that ends a word, which tells whose ids are whose.

    Kept words are of two generations; a word met again moves to the younger
    one, and when that is full the older one goes."""

    _plain = f"^[{_LETTERS}0-9{_SIGNS}]+$"
    _signs = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")
    _parts = f"[{_LETTERS}]+|[0-9]|[{_SIGNS}]+"

    def __init__(self, path: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not special  # else their strings in a text are ordinary text
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _joined(self, words: pa.Array) -> list[bytes]:
        """Ids of words of which it is known into how many pre-tokens they fall, encoded side by side."""
        parts = pc.count_substring_regex(words, self._parts).to_numpy(zero_copy_only=False)
        text = _strings(words)
        chunks = [" ".join(text[i : i + JOINED]) for i in range(0, len(text), JOINED)]
        ids = np.concatenate([np.empty(0, "<u4"), *(np.array(e.ids, "<u4") for e in self._tokenizer.encode_batch_fast(chunks, add_special_tokens=False))])
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != parts.sum() or (len(ends) and ends[-1] != len(ids)):
            raise ValueError("the tokenizer splits words in other places")
        data, cuts = ids.astype("<u4").tobytes(), [0, *(4 * ends[np.cumsum(parts) - 1]).tolist()]
        return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of new words.  Plain ones may share their lower-case stems, and the signs behind them."""
        array = pa.array(words, pa.string())
        # special strings begin with these two signs
        plain = pc.and_(pc.match_substring_regex(array, self._plain), pc.invert(pc.match_substring(array, "<|")))
        lower = pc.utf8_lower(array.filter(plain))
        stems = pc.utf8_rtrim(lower, self._signs).dictionary_encode()
        signs = pc.replace_substring_regex(lower, f"^.*[{_LETTERS}0-9]", "").dictionary_encode()
        lists = [[self._joined(d.dictionary.filter(pc.greater(pc.binary_length(d.dictionary), 0))), d] for d in (stems, signs)]
        for ids, d in lists:
            if (empty := pc.index(d.dictionary, "").as_py()) >= 0:
                ids.insert(empty, b"")
        (head, _), (tail, _) = lists
        side = (head[a] + tail[b] for a, b in zip(stems.indices.to_numpy().tolist(), signs.indices.to_numpy().tolist()))
        alone = (np.array(e.ids, "<u4").tobytes() for e in self._tokenizer.encode_batch_fast(_strings(array.filter(pc.invert(plain))), add_special_tokens=False))
        return [next(side) if p else next(alone) for p in plain.to_numpy(zero_copy_only=False).tolist()]

    def _ids(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text: distinct words are looked up, and their ids gathered."""
        if len(self._young) > CACHE_WORDS:
            self._old, self._young = self._young, {}
        young, old, lists = self._young, self._old, pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        words, codes = _strings(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
        data = [young.get(w) for w in words]
        missing = [i for i, ids in enumerate(data) if ids is None]
        again = [(i, old[words[i]]) for i in missing if words[i] in old]
        new = [i for i in missing if words[i] not in old]
        for i, ids in [*again, *zip(new, self._learn([words[i] for i in new]))]:
            data[i] = ids
            if len(words[i]) <= CACHE_CHARS:
                young[words[i]] = ids
        flat, sizes = np.frombuffer(b"".join(data), "<u4"), np.fromiter(map(len, data), np.int64, len(data)) // 4
        starts, each = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
        ends = np.concatenate([[0], np.cumsum(each)])
        ids = flat[np.repeat(starts - ends[:-1], each) + np.arange(ends[-1])]
        cuts = ends[lists.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """Little-endian uint32 ids of each text (null: none); short texts
        share their look-ups, long ones are cut at spaces."""
        texts = pc.replace_substring(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), "\t", " ")
        sizes, start = pc.binary_length(texts).to_numpy(zero_copy_only=False).tolist(), 0
        while start < len(sizes):
            end, size = start + 1, sizes[start]
            while end < len(sizes) and size + sizes[end] <= SLICE:
                size += sizes[end]
                end += 1
            if size <= SLICE:
                yield from self._ids(texts.slice(start, end - start))
            else:
                yield b"".join(ids for part in self._cut(texts[start].as_py()) for ids in self._ids(part))
            start = end

    def _cut(self, text: str) -> Iterator[pa.Array]:
        at = 0
        while at < len(text):
            end = text.find(" ", at + SLICE)
            end = len(text) if end < 0 else end
            yield pa.array([text[at:end]])
            at = end

    def encode(self, text: str | None) -> bytes:
        """Little-endian uint32 ids."""
        return next(self.encode_all(pa.array([text], pa.string())))


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def _encoder(path: str, special: bool = False) -> WordEncoder:
    if (path, special) not in _ENCODERS:
        _ENCODERS[path, special] = WordEncoder(path, special)
    return _ENCODERS[path, special]


def pieces(df: DataFrame, tokenizer_path: str, id_cols: Sequence[str] = ("doc_id",), text_col: str = "text", capacity: int = CAPACITY, special: bool = False) -> DataFrame:
    """``id_cols``, ``piece``, ``start``, ``length`` and ``ids_crc32`` of every
    piece: a document's ids and the end id, cut every ``capacity`` ids.  The
    tokenizer's special strings in a text are ordinary text or, if ``special``,
    one id each, as the library has it by default."""
    ids = list(id_cols)
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path, special)
        for batch in batches:
            row, out = [], []
            for i, data in enumerate(encoder.encode_all(batch.column(len(ids)))):
                data += end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    row.append(i)
                    out.append((k, at // 4, len(part) // 4, zlib.crc32(part)))
            k, start, length, crc = zip(*out) if out else ((), (), (), ())
            own = batch.take(pa.array(row, pa.int32())).columns[: len(ids)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(k, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], [*ids, "piece", "start", "length", "ids_crc32"])

    schema = T.StructType([*(df.schema[c] for c in ids), T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))])
    return df.select(*ids, F.col(text_col).alias("__text")).mapInArrow(run, schema)


def _groups(large: list[tuple[int, int]], n_groups: int) -> list[tuple[int, list[list[int]]]]:
    """(rounded size, [[length, count], ...]) of each group, longest first;
    ``large`` has (length, count), longest first."""
    total, out, members, room = sum(c for _, c in large), [], [], 0
    share = max(1, -(-total // n_groups))
    room = share
    for length, count in large:
        while count:
            take = min(count, room)
            members.append([length, take])
            count, room = count - take, room - take
            if not room:
                out.append((members[0][0], members))
                members, room = [], share
    return out + ([(members[0][0], members)] if members else [])


def _complete(sizes: list[int], left: list[int], room: int) -> dict[int, int]:
    """How often to take each size so that the sum is as large as possible but
    not over ``room`` (large sizes are preferred among equal sums)."""
    last = np.full(room + 1, -1, np.int64)  # the size that reached the sum last
    reached = np.zeros(room + 1, bool)
    reached[0] = True
    for g, size in enumerate(sizes):
        for _ in range(min(left[g], room // size)):
            fresh = np.zeros(room + 1, bool)
            fresh[size:] = reached[: room + 1 - size]
            fresh &= ~reached
            if not fresh.any():
                break
            reached |= fresh
            last[fresh] = g
        if reached[room]:
            break
    taken: dict[int, int] = defaultdict(int)
    at = int(np.nonzero(reached)[0][-1])
    while at:
        g = int(last[at])
        taken[g] += 1
        at -= sizes[g]
    return taken


def _configure(groups: list[tuple[int, list[list[int]]]], capacity: int) -> list[tuple[int, list[int]]]:
    """(times, group of each place) until all groups are used up."""
    sizes, left, out = [s for s, _ in groups], [sum(c for _, c in m) for _, m in groups], []
    for g in range(len(groups)):
        while left[g]:
            left[g] -= 1
            taken = _complete(sizes, left, capacity - sizes[g])
            left[g] += 1
            taken[g] += 1
            times = min(left[h] // n for h, n in taken.items())
            for h, n in taken.items():
                left[h] -= n * times
            out.append((times, [h for h, n in sorted(taken.items()) for _ in range(n)]))
    return out


def _substitute(groups: list[tuple[int, list[list[int]]]], configurations: list[tuple[int, list[int]]]) -> list[tuple[int, list[int]]]:
    """Runs (times, actual lengths) in place of configurations of groups."""
    out = []
    for times, places in configurations:
        while times:
            # as many equal sequences as the next member lengths of all places allow
            need: dict[tuple[int, int], int] = defaultdict(int)
            chosen, used = [], defaultdict(int)
            for g in places:
                members, k = groups[g][1], 0
                while k < len(members) - 1 and members[k][1] <= used[g, k]:
                    k += 1
                used[g, k] += 1
                need[g, k] += 1
                chosen.append(members[k][0])
            run = min([times, *(groups[g][1][k][1] // n for (g, k), n in need.items())])
            for (g, k), n in need.items():
                groups[g][1][k][1] -= n * run
            for g in {g for g, _ in need}:
                groups[g][1][:] = [m for m in groups[g][1] if m[1]]
            out.append((run, chosen))
            times -= run
    return out


def plan(counts: Mapping[int, int], capacity: int = CAPACITY, n_groups: int = GROUPS, small_part: int = SMALL_PART) -> list[tuple[int, list[int]]]:
    """Runs (number of sequences, lengths in each) that hold ``counts[length]``
    pieces of every length, no sequence over ``capacity``."""
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    lengths = sorted(((length, c) for length, c in counts.items() if c), reverse=True)
    large = [(length, c) for length, c in lengths if length * small_part > capacity]
    groups = _groups([x for x in large if x[0] < capacity], n_groups)
    runs = [(c, [length]) for length, c in large if length == capacity] + _substitute(groups, _configure(groups, capacity))
    by_room: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for times, places in runs:
        by_room[capacity - sum(places)].append((times, places))
    rooms = sorted(by_room)
    for length, count in lengths[len(large) :]:
        while count:
            at = bisect_left(rooms, length)
            if at == len(rooms):  # opens sequences, each filled with as many of this length as fit
                fit = min(count, capacity // length)
                new = (count // fit, [length] * fit)
                room = capacity - fit * length
                count -= new[0] * fit
            else:
                room = rooms[at]
                times, places = by_room[room].pop()
                if not by_room[room]:
                    rooms.pop(at)
                fit = min(count, room // length)
                new = (min(times, count // fit), [*places, *[length] * fit])
                if new[0] < times:
                    if not by_room[room]:
                        insort(rooms, room)
                    by_room[room].append((times - new[0], places))
                room -= fit * length
                count -= new[0] * fit
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append(new)
    return [run for room in sorted(by_room) for run in by_room[room]]


def pack(df: DataFrame, tokenizer_path: str, id_cols: Sequence[str] = ("doc_id",), text_col: str = "text", capacity: int = CAPACITY, n_groups: int = GROUPS, part_rows: int = PART_ROWS, special: bool = False) -> DataFrame:
    """Every piece (see ``pieces``) with ``sequence_id`` (long) and ``offset``
    (long), its place there; places are gapless from 0.

    Null and empty texts are documents of the end id alone.  Repeated rows are
    packed each for itself.  Other columns of ``df`` are not read.  Ties of
    equal lengths are numbered by id and piece.  An empty table gives an empty
    result.
    """
    ids = list(id_cols)
    table = materialize(pieces(df, tokenizer_path, ids, text_col, capacity, special), "packing-pieces")
    counts = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    parts = max(1, -(-max(counts.values(), default=0) // part_rows))
    # places by (length, number within the length): where each run of places begins
    used, sequences, rows = defaultdict(int), 0, []
    for times, lengths in plan(counts, capacity, n_groups):
        at = 0
        for length in lengths:
            rows.append((length, used[length], sequences, at))
            used[length] += times
            at += length
        sequences += times
    rows.sort()
    lengths, firsts, bases, offsets = (np.array(c, np.int64) for c in (zip(*rows) if rows else ((), (), (), ())))

    salted = table.withColumn("__part", F.pmod(F.xxhash64(*ids, "piece"), F.lit(parts)))
    own = Window.partitionBy("length", "__part").orderBy(*ids, "piece", "ids_crc32")
    sizes = salted.groupBy("length", "__part").agg(F.count("*").alias("__n"))
    before = sizes.select("length", "__part", (F.sum("__n").over(Window.partitionBy("length").orderBy("__part")) - F.col("__n")).alias("__before"))
    numbered = salted.withColumn("__row", F.row_number().over(own)).join(before, ["length", "__part"]).withColumn("__number", F.col("__row") - 1 + F.col("__before"))
    columns = [*ids, "piece", "start", "length", "ids_crc32"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a piece's run of places: the last one of its length that begins at or before its number
        keys = lengths * (1 << 48) + firsts
        for batch in batches:
            length, number = batch.column(columns.index("length")).to_numpy(), batch.column(len(columns)).to_numpy()
            at = np.searchsorted(keys, length * (1 << 48) + number, side="right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(bases[at] + number - firsts[at]), pa.array(offsets[at])], [*columns, "sequence_id", "offset"])

    schema = T.StructType([*(table.schema[c] for c in columns), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return numbered.select(*columns, "__number").mapInArrow(place, schema)

"""Best-fit packing of token sequences (operator 4).

Documents are tokenised in tasks; only documents longer than a sequence are cut.  The
pieces are then packed by best-fit decreasing: longest first, each into the open
sequence with the least room that is enough.

Best-fit decreasing needs no look at single pieces.  All pieces of one length are alike
and so are all open sequences with the same room, so the exact packing of any number
of pieces follows from the count of pieces per length (at most ``capacity`` numbers).
``plan`` keeps the open sequences as intervals of numbers per remaining room, in a
segment tree over the rooms 0 to ``capacity`` whose descent finds the tightest room in
log(capacity) steps, and serves whole runs of equal pieces at once.  Its answer, runs of
(length, ranks, sequences, offset), is a small table that is broadcast to the ranked pieces
(``BROADCAST_ROWS`` at most; a larger one would be joined by a shuffle on the length).  Ranks
are counted per (length, salt), so the pieces of one length, however frequent, are neither sorted
nor joined in one task.

Defined cases: null text is empty, so its one piece is the end id alone; null ids and
repeated rows are packed like others (pieces are told apart by a row key); other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import write_shared
from .common import parallelism, ranges, slices, split_words

CAPACITY = 4096
END_ID = 1
TRAILING = ".,!?;:"
#: units whose ids a Python worker keeps between tasks (about 30 bytes each)
KEPT_UNITS = 4_000_000

_PIECES = "id long, n_chars long, piece int, start long, length long, ids_crc32 long, salt int"


def _without_punctuation(words: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Words without trailing punctuation, that punctuation, and whose it is.  Only what
    follows a letter or digit is cut off: other signs may form one token with it.  The
    dotted capital I is left alone, as its lower case ends in a combining mark."""
    trimmed = pc.ascii_rtrim(words, TRAILING)
    shorter = pc.less(pc.binary_length(trimmed), pc.binary_length(words))
    at = np.flatnonzero(shorter.to_numpy(zero_copy_only=False))
    some = trimmed.take(pa.array(at))
    safe = pc.and_not(pc.match_substring_regex(some, r"[\p{L}\p{N}]$"), pc.ends_with(some, "\u0130"))
    at = at[safe.to_numpy(zero_copy_only=False)]
    cut = np.zeros(len(words), bool)
    cut[at] = True
    tails = pc.extract_regex(words.take(pa.array(at)), f"(?P<tail>[{TRAILING}]+)$").field("tail")
    return pc.if_else(pa.array(cut), trimmed, words), tails, at


class UnitTokenizer:
    """Token ids of texts, by way of their distinct units.

    A unit is a word of the lower-cased text (A-Z only, the tokenizer does the rest)
    without the punctuation after its last letter, or that punctuation.  This suits tokenizers that
    lower-case, drop white space and never join a letter with the punctuation after it;
    the ids are then those of the whole text.  Units are known by a 64-bit hash; their ids
    are kept between tasks in sorted arrays of bounded size."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.offsets = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, units: list[str]) -> None:
        new, counts = [], []
        for i in range(0, len(units), 10_000):
            for e in self.tokenizer.encode_batch_fast(units[i:i + 10_000], add_special_tokens=False):
                new += e.ids
                counts.append(len(e.ids))
        lengths = np.concatenate([np.diff(self.offsets), np.array(counts, np.int64)])
        starts = np.cumsum(lengths) - lengths
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys)
        self.ids = np.concatenate([self.ids, np.array(new, np.uint32)])[ranges(starts[order], lengths[order])]
        self.keys, self.offsets = keys[order], np.concatenate([[0], np.cumsum(lengths[order])])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and each text's offset into them."""
        words, offsets = split_words(texts)
        raw = pc.match_substring(words, "<|")  # special tokens are known by their exact case
        words = pc.if_else(raw, words, pc.ascii_lower(words))
        bare, tails, tail_of = _without_punctuation(words)
        ends_early = np.zeros(len(words), bool)
        ends_early[tail_of] = True
        coded = pa.concat_arrays([bare, tails]).dictionary_encode()
        units = coded.dictionary.to_numpy(zero_copy_only=False)
        if not len(units):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        keys = pd.util.hash_array(units, categorize=False)
        if len(self.keys) > KEPT_UNITS:
            self.forget()
        found = np.searchsorted(self.keys, keys)
        missing = np.ones(len(keys), bool)
        inside = found < len(self.keys)
        missing[inside] = self.keys[found[inside]] != keys[inside]
        if missing.any():
            self._learn(keys[missing], units[missing].tolist())
            found = np.searchsorted(self.keys, keys)
        unit_at = found[coded.indices.to_numpy()]
        # each word's unit, then its punctuation, in text order
        place = np.arange(len(words)) + np.cumsum(ends_early) - ends_early
        order = np.zeros(len(unit_at), np.int64)
        order[place] = unit_at[:len(words)]
        order[place[tail_of] + 1] = unit_at[len(words):]
        lengths = self.offsets[order + 1] - self.offsets[order]
        ids = self.ids[ranges(self.offsets[order], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        units_before = np.concatenate([[0], np.cumsum(1 + ends_early)])[offsets]
        return ids, ends[units_before]


_tokenizers: dict[str, UnitTokenizer] = {}


def tokenizer(path: str) -> UnitTokenizer:
    if path not in _tokenizers:
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _tokenizers[path] = UnitTokenizer(path)
    return _tokenizers[path]


def _pieces(path: str, capacity: int, end_id: int, salts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets = encode(part.column("text"))
                rows, piece, start, length, crc, chars = [], [], [], [], [], \
                    pc.fill_null(pc.utf8_length(part.column("text")), 0).to_pylist()
                for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                    for k, s in enumerate(range(0, len(own), capacity)):
                        part_ids = own[s:s + capacity]
                        rows.append(row)
                        piece.append(k)
                        start.append(s)
                        length.append(len(part_ids))
                        crc.append(zlib.crc32(part_ids.tobytes()))
                at = pa.array(rows, pa.int64())
                crcs = np.array(crc, np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column("id").take(at), pa.array(chars, pa.int64()).take(at), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crcs),
                    pa.array((np.arange(len(rows)) % salts).astype(np.int32))],
                    names=["id", "n_chars", "piece", "start", "length", "ids_crc32", "salt"])
    return run


#: rows of the plan (40 bytes each) that are sent to every task
BROADCAST_ROWS = 500_000


class RoomTree:
    """Segment tree over remaining rooms 0 .. capacity; each leaf holds intervals
    [first, last) of numbers of open sequences with that room."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = np.zeros(2 * self.size, np.int64)  # intervals below a node
        self.leaves: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, change: int) -> None:
        node = self.size + room
        while node:
            self.open[node] += change
            node >>= 1

    def put(self, room: int, interval: tuple[int, int]) -> None:
        self.leaves[room].append(interval)
        self._add(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._add(room, -1)
        return self.leaves[room].pop()

    def tightest(self, room: int) -> int | None:
        """The smallest room that is at least ``room`` and has an open sequence."""
        node = self.size + room
        if self.open[node]:
            return room
        while node > 1 and (node & 1 or not self.open[node + 1]):  # up to a filled right neighbour
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self.size:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.size


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing for ``counts`` pieces of each length: rows (length, first rank,
    last rank + 1, first sequence, offset) with one sequence per rank."""
    tree, rows, opened = RoomTree(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, last = capacity, opened, opened + -(-left // (capacity // length))
                opened = last
            else:
                first, last = tree.take(room)
            # the next pieces of this length go to the same sequence until it has no more
            # room for one: ``fit`` pieces into each of ``full`` sequences, the rest into one
            fit = room // length
            full = min(last - first, left // fit)
            for layers, n in ((fit, full), (left - fit * full, 1) if left - fit * full < fit and first + full < last else (0, 0)):
                if not layers or not n:
                    continue
                for j in range(layers):
                    rows.append((length, rank, rank + n, first, capacity - room + j * length))
                    rank += n
                tree.put(room - layers * length, (first, first + n))
                first += n
                left -= layers * n
            if first < last:
                tree.put(room, (first, last))
    return rows


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``id_col``, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    spark = docs.sparkSession
    salts = 4 * parallelism(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    pieces = write_shared(texts.mapInArrow(_pieces(tokenizer_path, capacity, end_id, salts), _PIECES))
    return place(pieces, capacity).withColumnRenamed("id", id_col)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (id, piece, start, length, ids_crc32, salt)."""
    spark = pieces.sparkSession
    per_salt = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    base = per_salt.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n"))
                           .alias("base"))
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    planned = plan(counts, capacity)
    steps = spark.createDataFrame(planned, "at long, first_rank long, last_rank long, first_sequence long, offset long")
    if len(planned) <= BROADCAST_ROWS:   # else the pieces of one length meet in one task
        steps = F.broadcast(steps)
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32"))
    ranked = pieces.withColumn("own", own).join(base, ["length", "salt"]).withColumn(
        "rank", F.col("base") + F.col("own") - 1)
    return (ranked.join(steps, (F.col("length") == F.col("at")) & (F.col("rank") >= F.col("first_rank"))
                        & (F.col("rank") < F.col("last_rank")))
            .select("id", "piece", "start", "length", "ids_crc32",
                    (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset"))

"""Substring dedup by super-k-mer partitioning (operator 8).

A window is ``width`` consecutive words of one document.  Its minimiser is the smallest
hash among its runs of ``mer`` words, so equal windows have equal minimisers.
Consecutive windows of a document that share the minimiser form a super-k-mer and
travel as one packed string (the words once, not once per window) to the minimiser's
bucket.  There the windows are sorted and every one whose sequence also starts in a
document with a smaller id is marked.

Memory and skew: texts are handled in slices of ``SLICE`` bytes; of equal super-k-mers
in a slice only those of the smallest id travel, the others are marked on the spot (a
smaller id has every window of theirs).  So a passage held by a third of all documents
reaches its bucket at most once per slice.  A task holds one bucket at a time; there
are ``BUCKETS_PER_PARTITION`` buckets per shuffle partition.

Defined cases: null text has no words; a text of fewer than ``width`` words is kept
whole; repeats inside one document are kept; a null id is never compared and keeps its
words; ids are taken to name one text; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import hash_strings, hash_windows, mix, parallelism, ranges, slices, split_words

SLICE = 8 << 20
BUCKETS_PER_PARTITION = 8

_PACKED = "bucket int, runs int, marked boolean, places binary, words binary, words_bytes long"
_RUNS = "id long, first int, windows int"


def _sliding_min(x: np.ndarray, span: int) -> np.ndarray:
    done = 1
    while 2 * done <= span:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[:len(x) - (span - done)], x[span - done:]) if done < span else x


def _joined(flat: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), flat), " ")


def _super_k_mers(ids: np.ndarray, texts: pa.Array, width: int, mer: int):
    """(minimiser, id, first word, windows, packed words) of every super-k-mer, as arrays."""
    flat, offsets = split_words(texts)
    counts = np.diff(offsets)
    long_enough = counts >= width
    if not long_enough.any():
        return None
    mers = hash_windows(hash_strings(flat), mer)
    least = _sliding_min(mers, width - mer + 1)
    at = ranges(offsets[:-1][long_enough], counts[long_enough] - width + 1)
    row = np.repeat(np.flatnonzero(long_enough), counts[long_enough] - width + 1)
    least = least[at]
    starts = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (row[1:] != row[:-1])]))
    windows = np.diff(np.append(starts, len(at)))
    first, row, least = at[starts], row[starts], least[starts]

    joined = _joined(flat, offsets)
    data = joined.buffers()[2].to_pybytes()
    sizes = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    blanks = np.repeat(np.cumsum(counts > 0) - 1, counts)  # a text has no blank after its last word
    begin = np.cumsum(sizes + 1) - (sizes + 1) - blanks
    final = first + windows + width - 2
    packed = [data[a:b] for a, b in zip(begin[first].tolist(), (begin[final] + sizes[final]).tolist())]
    return least, ids[row], first - offsets[:-1][row], windows, packed


def _pack(width: int, mer: int, buckets: int):
    def row(bucket, marked, ids, first, windows, packed):
        places = np.concatenate([ids.astype(np.int64), first.astype(np.int64), windows.astype(np.int64)]).tobytes()
        words = b"\n".join(packed)
        return (bucket, len(ids), marked, pa.compress(places, "zstd", asbytes=True),
                pa.compress(words, "zstd", asbytes=True), len(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = _super_k_mers(part.column("id").to_numpy(), part.column("text"), width, mer)
                if found is None:
                    continue
                least, ids, first, windows, packed = found
                code = pa.array(packed, pa.binary()).dictionary_encode().indices.to_numpy()
                smallest = np.full(code.max() + 1, np.iinfo(np.int64).max)
                np.minimum.at(smallest, code, ids)
                marked = ids > smallest[code]
                bucket = (mix(least) % np.uint64(buckets)).astype(np.int64)
                out = []
                for mark in (True, False):
                    mine = np.flatnonzero(marked == mark)
                    mine = mine[np.argsort(bucket[mine], kind="stable")]
                    cuts = np.flatnonzero(np.diff(bucket[mine])) + 1
                    for group in np.split(mine, cuts) if len(mine) else []:
                        strings = [] if mark else [packed[i] for i in group.tolist()]
                        out.append(row(int(bucket[group[0]]), mark, ids[group], first[group], windows[group], strings))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([
                    pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.bool_()),
                    pa.array(columns[3], pa.binary()), pa.array(columns[4], pa.binary()),
                    pa.array(columns[5], pa.int64())],
                    names=["bucket", "runs", "marked", "places", "words", "words_bytes"])
    return run


def _run_rows(ids: np.ndarray, first: np.ndarray, windows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(first.astype(np.int32)),
                                       pa.array(windows.astype(np.int32))], names=["id", "first", "windows"])


def _marked_windows(ids: np.ndarray, first: np.ndarray, windows: np.ndarray, words: bytes,
                    width: int) -> pa.RecordBatch:
    """Sort the windows of a bucket; those that a smaller id holds, as runs of windows."""
    codes = pc.ascii_split_whitespace(pa.array([words], pa.large_string())).flatten()
    codes = codes.dictionary_encode().indices.to_numpy().astype(np.int64)
    lengths = windows + width - 1
    begins = np.cumsum(lengths) - lengths
    at = ranges(begins, windows)
    owner = np.repeat(ids, windows)
    start = ranges(first, windows)
    key = hash_windows(mix(codes.astype(np.uint64) + np.uint64(1)), width)[at]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    order = order[shared]
    if not len(order):
        return _run_rows(*[np.zeros(0, np.int64)] * 3)
    equal = key[order][1:] == key[order][:-1]
    pairs = np.flatnonzero(equal)
    for i in range(width):  # equal hashes are held against the words themselves
        if not (codes[at[order[pairs]] + i] == codes[at[order[pairs + 1]] + i]).all():
            grid = codes[at[order][:, None] + np.arange(width)]
            exact = np.unique(grid, axis=0, return_inverse=True)[1].ravel()
            by = np.argsort(exact, kind="stable")
            order, exact = order[by], exact[by]
            equal = exact[1:] == exact[:-1]
            break
    heads = np.flatnonzero(np.concatenate([[True], ~equal]))
    smallest = np.repeat(np.minimum.reduceat(owner[order], heads), np.diff(np.append(heads, len(order))))
    hit = order[owner[order] > smallest]
    hit = hit[np.lexsort((start[hit], owner[hit]))]
    o, s = owner[hit], start[hit]
    if not len(o):
        return _run_rows(*[np.zeros(0, np.int64)] * 3)
    cut = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (s[1:] != s[:-1] + 1)]))
    return _run_rows(o[cut], s[cut], np.diff(np.append(cut, len(o))))


def _count_buckets(width: int):
    def places(row):
        return np.frombuffer(pa.decompress(row["places"], 24 * row["runs"], "zstd", asbytes=True),
                             np.int64).reshape(3, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, bytes]] = []
        bucket = None

        def flush():
            if held:
                ids, first, windows = np.concatenate([p for p, _ in held], axis=1)
                words = b"\n".join(w for _, w in held)
                held.clear()
                yield _marked_windows(ids, first, windows, words, width)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["marked"]:
                    yield _run_rows(*places(row))
                    continue
                if row["bucket"] != bucket:
                    yield from flush()
                    bucket = row["bucket"]
                held.append((places(row), pa.decompress(row["words"], row["words_bytes"], "zstd", asbytes=True)))
        yield from flush()
    return run


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13,
                     mer: int = 3) -> DataFrame:
    """(id, first, windows): runs of consecutive windows, by their first word's number in
    the text, whose word sequences all start in documents with smaller ids as well."""
    spark = docs.sparkSession
    partitions = parallelism(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter(
        "id is not null and text is not null")
    packed = texts.mapInArrow(_pack(width, mer, BUCKETS_PER_PARTITION * partitions), _PACKED)
    return (packed.repartition(partitions, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(_count_buckets(width), _RUNS))


def _keep(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                flat, offsets = split_words(part.column("text"))
                spans = part.column("spans")
                covered = np.zeros(len(flat), bool)
                if spans.null_count < len(spans):
                    counts = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
                    runs = spans.flatten()
                    row = np.repeat(np.arange(part.num_rows), counts)
                    first = runs.field("first").to_numpy().astype(np.int64) + offsets[:-1][row]
                    last = first + runs.field("windows").to_numpy() + width - 1
                    change = np.zeros(len(flat) + 1, np.int64)
                    np.add.at(change, np.minimum(first, offsets[1:][row]), 1)
                    np.add.at(change, np.minimum(last, offsets[1:][row]), -1)
                    covered = np.cumsum(change)[:-1] > 0
                left = np.concatenate([[0], np.cumsum(~covered)])[offsets]
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array(np.diff(offsets), pa.int64()),
                    pa.array(np.diff(offsets) - np.diff(left), pa.int64()),
                    _joined(flat.filter(pa.array(~covered)), left)], names=["id", "n_words", "n_removed", "kept"])
    return run


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13,
                    mer: int = 3) -> DataFrame:
    """``id_col``, n_words, n_removed and kept (the words that stay, joined by one space)
    for every input row."""
    runs = repeated_windows(docs, id_col, text_col, width, mer)
    spans = runs.groupBy("id").agg(F.collect_list(F.struct("first", "windows")).alias("spans"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return (texts.join(spans, "id", "left").select("id", "text", "spans")
            .mapInArrow(_keep(width), "id long, n_words long, n_removed long, kept string")
            .withColumnRenamed("id", id_col))

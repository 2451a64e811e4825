"""Helpers shared by the text operators.

Word semantics everywhere in this subpackage: words are maximal runs of bytes other
than ASCII white space (space, tab, line feed, vertical tab, form feed, carriage
return).  Arrow's ``ascii_split_whitespace`` splits on exactly that set.

The helpers below run inside tasks on Arrow batches.  A batch is processed in slices
of a few MB of text, so the memory of a Python worker does not depend on how many
rows Spark puts into a batch; a single text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLICE_BYTES = 4 << 20
#: hash values of ``id_marks``: 4 MB of bits
MARK_BITS = 1 << 25

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """Bind ``value`` once per row as a lambda variable and evaluate ``body(variable)``.
    Inside nested lambdas a plain column expression would be evaluated per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_marks(ids: DataFrame, bits: int = MARK_BITS) -> DataFrame:
    """(bucket, marked) of the ids in the one column of ``ids``: a bitmap with a bit for each of ``bits``
    hash values, in rows of 4 KB.  Its broadcast has a fixed size, whatever the input."""
    at = F.pmod(F.xxhash64(ids.columns[0]), F.lit(bits)) + 1
    return ids.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("marked"))


def with_mark(rows: DataFrame, marks: DataFrame, bits: int = MARK_BITS) -> DataFrame:
    """``rows`` (with a column id) and a column ``mark``: false only if the id is not among those of ``marks``.
    A few others share a bit with one of them, so what is marked still needs an exact join."""
    at = F.pmod(F.xxhash64("id"), F.lit(bits)) + 1
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("marked", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) > 0
    return rows.withColumn("bucket", F.bitmap_bucket_number(at)).join(F.broadcast(marks), "bucket", "left").select(
        *rows.columns, F.coalesce(bit, F.lit(False)).alias("mark"))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch between rows into slices of about ``max_bytes`` of ``column``."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes) - sizes) // max_bytes
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(int(a), int(b - a))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in one flat array, and row offsets into it (null: no words)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not filled.all():
        offsets = np.concatenate([[0], np.cumsum(filled)])[offsets]
        flat = flat.filter(pa.array(filled))
    return flat, offsets


def hash_strings(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string; equal on every executor."""
    encoded = values.dictionary_encode()
    if not len(encoded):
        return np.zeros(0, np.uint64)
    each = pd.util.hash_array(encoded.dictionary.to_numpy(zero_copy_only=False), categorize=False)
    return each[encoded.indices.to_numpy()]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def hash_windows(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive hashes, in order."""
    n = len(word_hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, width, np.uint64) * _M1
    for i in range(width):
        out = (out ^ word_hashes[i:i + n]) * _M2
        out ^= out >> np.uint64(29)
    return mix(out)


def lower_ascii(texts: pa.Array) -> pa.Array:
    return pc.ascii_lower(texts)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + length), one after the other."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)

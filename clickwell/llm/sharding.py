"""Sharding by a permutation-filled lookup table (operator 7).

As in Maglev hashing (Eisenbud et al. 2016): every shard orders the slots of a
prime-sized table by a permutation of its own, (offset + j * skip) mod size, and shards
take turns claiming the next free slot of their order.  Slots are shared almost evenly,
and when a shard comes or goes few slots of the others change.  A document's slot is a
hash of its key, so placing it is one look-up in the broadcast table, whose size is fixed
(``size`` rows).  Weighted shards take as many turns per round as their weight.

Nothing is shuffled to place documents: neither a frequent source nor a large group of
copies weighs on a task.

Defined cases: a null key is hashed as the text ``null``; repeated keys get one shard;
an empty table gives an empty result; other columns are kept, and clashing names are the
caller's to choose (``slot_col``, ``shard_col``).
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
from pyspark.sql import DataFrame, functions as F

SIZE = 65_537


@dataclass(frozen=True)
class Shards:
    names: tuple[str, ...]
    weights: tuple[int, ...]

    @staticmethod
    def numbered(n: int) -> "Shards":
        return Shards(tuple(f"shard-{i:05d}" for i in range(n)), (1,) * n)


def _number(name: str, use: str) -> int:
    return int.from_bytes(blake2b(f"{use}:{name}".encode(), digest_size=8).digest(), "little")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: Shards, size: int = SIZE) -> np.ndarray:
    """The number of the shard that holds each slot.  A shard's place in the turns follows
    from its name, not from its position in the list."""
    if not is_prime(size):
        raise ValueError("the table size must be prime")
    if not shards.names or len(set(shards.names)) != len(shards.names) or min(shards.weights) < 1 \
            or len(shards.weights) != len(shards.names):
        raise ValueError("shards need distinct names and weights of at least 1")
    if sum(shards.weights) > size:
        raise ValueError("more turns a round than slots")
    turns = sorted(range(len(shards.names)), key=lambda i: shards.names[i])
    at = [_number(name, "offset") % size for name in shards.names]
    skip = [_number(name, "skip") % (size - 1) + 1 for name in shards.names]
    owner, left = [-1] * size, size
    while True:
        for i in turns:
            for _ in range(shards.weights[i]):
                while owner[at[i]] >= 0:
                    at[i] = (at[i] + skip[i]) % size
                owner[at[i]] = i
                left -= 1
                if not left:
                    return np.array(owner)


def assign(docs: DataFrame, shards: Shards, key_col: str = "doc_id", size: int = SIZE,
           slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``docs`` with the slot and the shard of every row."""
    owner = lookup_table(shards, size)
    table = docs.sparkSession.createDataFrame(
        [(i, shards.names[s]) for i, s in enumerate(owner.tolist())], f"__slot int, `{shard_col}` string")
    slot = F.pmod(F.xxhash64(F.coalesce(F.col(key_col).cast("string"), F.lit("null"))), F.lit(size)).cast("int")
    placed = docs.withColumn(slot_col, slot)
    return placed.join(F.broadcast(table), F.col(slot_col) == F.col("__slot"), "left").drop("__slot")


def write_shards(docs: DataFrame, shards: Shards, path: str, key_col: str = "doc_id", size: int = SIZE) -> None:
    """Write the documents as one folder per shard.  Rows are rebalanced by shard, so the
    files of a shard are of even size and a large shard is split over tasks."""
    assign(docs, shards, key_col, size).hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(path)

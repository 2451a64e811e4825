from collections import Counter

import numpy as np
import pytest

from clickwell.llm.sharding import Shards, assign, lookup_table, write_shards
from helpers import awkward_rows, frame


def brute(names, size):
    """Turns over explicit permutations."""
    from clickwell.llm.sharding import _number
    order = {n: [(_number(n, "offset") % size + j * (_number(n, "skip") % (size - 1) + 1)) % size for j in range(size)] for n in names}
    owner, used = {}, Counter()
    while len(owner) < size:
        for n in sorted(names):
            while order[n][used[n]] in owner:
                used[n] += 1
            owner[order[n][used[n]]] = n
            if len(owner) == size:
                break
    return [owner[i] for i in range(size)]


def test_table_equals_brute_force_and_is_even():
    shards = Shards(tuple("abcdefg"), (1,) * 7)
    assert [shards.names[i] for i in lookup_table(shards, 101)] == brute(shards.names, 101)
    counts = Counter(lookup_table(Shards.numbered(64)).tolist()).values()
    assert max(counts) - min(counts) <= 1


def test_few_slots_move_when_a_shard_goes():
    a = Shards.numbered(20)
    b = Shards(a.names[:7] + a.names[8:], (1,) * 19)
    x, y = lookup_table(a), lookup_table(b)
    moved = [s for s in range(len(x)) if a.names[x[s]] != b.names[y[s]] and x[s] != 7]
    assert len(moved) < 0.05 * len(x)


def test_weights_and_errors():
    x = lookup_table(Shards(("a", "b"), (3, 1)), 1009)
    assert abs(np.mean(x == 0) - 0.75) < 0.01
    for bad in (lambda: lookup_table(Shards.numbered(3), 100), lambda: lookup_table(Shards(("a", "a"), (1, 1)), 7),
                lambda: lookup_table(Shards((), ()), 7)):
        with pytest.raises(ValueError):
            bad()


def test_assign_and_write(spark, scratch):
    docs = frame(spark)
    got = assign(docs, Shards.numbered(4))
    assert got.count() == len(awkward_rows()) and got.columns == docs.columns + ["slot", "shard"]
    assert got.filter("slot is null or shard is null").count() == 0
    assert got.select("doc_id", "shard").distinct().count() == len({r[0] for r in awkward_rows()})
    assert assign(frame(spark, []), Shards.numbered(4)).count() == 0
    write_shards(docs, Shards.numbered(4), f"{scratch}/shards")
    back = spark.read.parquet(f"{scratch}/shards")
    assert sorted((r.doc_id or -1, r.shard) for r in back.collect()) == sorted((r.doc_id or -1, r.shard) for r in got.collect())

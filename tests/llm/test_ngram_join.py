import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from clickwell.llm import ngram_join
from clickwell.llm.ngram_join import keep_one_of_each, similarity_classes
from helpers import SCHEMA, awkward_rows, frame, noisy_copies, union_find, words


def shingles(text, n):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(texts, n, num, den):
    sets = [shingles(t, n) for t in texts]
    find, link = union_find(len(texts))
    for i, x in enumerate(sets):
        for j in range(i):
            k = len(x & sets[j])
            if x and sets[j] and den * k >= num * (len(x) + len(sets[j]) - k):
                link(i, j)
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("n, num", [(3, 90), (5, 80), (2, 60)])
def test_classes_equal_brute_force(spark, n, num):
    texts = noisy_copies(random.Random(n)) + ["", "only two", "Only TWO", "only"]
    got = {r.doc_id: r for r in similarity_classes(
        frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]), n=n, num=num).collect()}
    sizes, classes = brute(texts, n, num, 100)
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert [got[i].component_id for i in range(len(texts))] == classes
    assert len(set(classes)) < len(texts)


def test_chain_of_copies_without_a_common_first_member(spark):
    """Each text is near the next only, so links must be followed along the chain."""
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:i] + [f"v{j}" for j in range(i)] and ([f"v{j}" for j in range(i)] + base[i:])) for i in range(30)]
    got = {r.doc_id: r.component_id for r in similarity_classes(
        frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]), n=3, num=90).collect()}
    assert [got[i] for i in range(30)] == brute(texts, 3, 90, 100)[1]


def test_awkward_rows(spark):
    rows = awkward_rows()
    got = similarity_classes(frame(spark), n=3, num=90)
    assert got.count() == len(rows)
    by_id = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert by_id[1].n_shingles == 0 and by_id[1].component_id == 1
    assert by_id[16].component_id == by_id[19].component_id == 16
    assert by_id[22].component_id == 22   # upper-cased: only A-Z are lower-cased, so some letters differ (106 of 130 shingles)
    assert all(r.component_id is None for r in got.collect() if r.doc_id is None)


def test_empty_table_and_kept_documents(spark):
    assert similarity_classes(frame(spark, [])).count() == 0
    assert keep_one_of_each(frame(spark, [])).count() == 0
    docs = frame(spark).withColumnsRenamed({"source": "n_shingles", "lang": "node"})
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert len(ids) == len(set(ids)) and 16 in ids and 19 not in ids and 25 in ids
    assert kept.filter("doc_id is null").count() == 2


def test_texts_in_no_pair_stay_where_they_are(spark, monkeypatch):
    """Of documents that are like no other, neither the text nor the row is sent to be joined; ids that
    are dropped or repeated are judged exactly."""
    from clickwell.llm import ngram_join
    sent, marking = [], ngram_join.with_mark

    def counted(rows, marks):
        out = marking(rows, marks)
        sent.append((rows.count(), out.filter("mark").count()))
        return out

    monkeypatch.setattr(ngram_join, "with_mark", counted)
    alone = [(i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(300)]
    common = " ".join(f"c{k}" for k in range(40))
    rows = alone + [(1000, common), (1001, common + " end"), (1002, alone[5][1]), (7, alone[7][1]), (None, common)]
    kept = keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in kept.collect()) == sorted(
        alone + [(1000, common), (-1, common)])
    assert sent and all(n >= 304 and marked <= 6 for n, marked in sent)


def test_a_task_sends_its_counts_and_prefixes_in_small_batches():
    """No Arrow batch of the two passes grows with the text that a task holds; the counts are those of the sets."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(4000)) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["id", "text"])
    first = list(ngram_join._first_pass(5, True, 20)(iter([batch])))
    blocks = pa.Table.from_batches(first).select(["block", "counts"]).drop_null()
    counts = np.zeros(1 << 20, np.int64)
    for out in ngram_join._add_blocks(iter(blocks.to_batches())):
        for block, part in zip(out.column("block").to_pylist(), out.column("counts").to_pylist()):
            counts[block * ngram_join.BLOCK:(block + 1) * ngram_join.BLOCK] = np.frombuffer(part, np.int64)
    held = np.concatenate(list(ngram_join._sets(batch.column("text"), 5, True)))
    assert (counts == np.bincount(ngram_join._cells(held, 20), minlength=1 << 20)).all()
    shared = SimpleNamespace(value=counts.astype(np.int32))
    prefixes = list(ngram_join._prefixes(5, True, 20, 80, 100, shared)(iter([batch, batch])))
    assert max(x.nbytes for x in first) < 1 << 20 and max(x.nbytes for x in prefixes) < 3 << 20


def test_components_are_computed_again_only_where_late_links_join_them(spark, monkeypatch):
    """Without late links the components are computed once; with some, only over components."""
    calls, plain = [], ngram_join.components

    def counted(links, *names):
        calls.append(links.count())
        return plain(links, *names)

    monkeypatch.setattr(ngram_join, "components", counted)
    base = " ".join(f"c{k}" for k in range(40))
    similarity_classes(spark.createDataFrame([(1, base), (2, base + " end"), (3, "another text")], "doc_id long, text string"))
    assert calls == [1]
    rng = random.Random(5)
    for _ in range(3):
        find, link = union_find(60)
        early = [(rng.randrange(60), rng.randrange(60)) for _ in range(25)]
        late = [(rng.randrange(60), rng.randrange(60)) for _ in range(12)]
        for x, y in early + late:
            link(x, y)
        pairs = lambda x: spark.createDataFrame(x, "a long, b long")
        got = {r.node: r.component for r in ngram_join._joined(plain(pairs(early)), pairs(late)).collect()}
        assert got == {x: find(x) for pair in early + late if pair[0] != pair[1] for x in pair} | {
            x: find(x) for x in got if x == find(x)}
        assert {x for x, y in early + late if x != y} <= set(got)

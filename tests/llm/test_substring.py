import random

from clickwell.llm.substring import remove_repeated, repeated_windows
from helpers import awkward_rows, frame, prose, words


def brute(rows, width):
    first = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - width + 1):
            g = tuple(w[p:p + width])
            first[g] = min(first.get(g, i), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = set()
        for p in range(len(w) - width + 1):
            if first[tuple(w[p:p + width])] < i:
                gone |= set(range(p, p + width))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(3)
    passages = [prose(rng, 60) for _ in range(4)]
    texts = []
    for _ in range(60):
        parts = [prose(rng, rng.randint(0, 40)) for _ in range(3)]
        if rng.random() < 0.7:
            p = rng.choice(passages).split()
            a = rng.randint(0, 30)
            parts.insert(1, "  ".join(p[a:a + rng.randint(10, 40)]))
        texts.append("\n".join(parts))
    texts += [texts[0], texts[5], "same " * 50, "same " * 30, prose(rng, 12), prose(rng, 13)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = frame(spark, [(i, t, None, None, None) for i, t in rows]).repartition(5)
    for width, mer in ((13, 3), (5, 2), (3, 3)):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_repeated(docs, width=width, mer=mer).collect()}
        assert got == brute(rows, width)


def test_awkward_rows(spark):
    got = remove_repeated(frame(spark).withColumnRenamed("source", "kept"))
    assert got.count() == len(awkward_rows())
    by_id = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert (by_id[1].n_words, by_id[1].n_removed, by_id[1].kept) == (0, 0, "")
    assert by_id[16].n_removed == 0 and by_id[19].n_removed == by_id[19].n_words == 120
    assert by_id[25].n_words == 30_000 and by_id[25].n_removed == 0
    assert all(r.n_removed == 0 for r in got.collect() if r.doc_id is None)
    assert remove_repeated(frame(spark, [])).count() == 0
    assert repeated_windows(frame(spark, [])).count() == 0

import random
import re
import zlib
from collections import Counter

import pytest

from clickwell.llm import spelling
from clickwell.llm.queries import QUERIES
from helpers import awkward_rows, frame

SF = "/root/testdata/sf0.001"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) >= len(b)):] == b[k + (len(b) >= len(a)):]


def brute_words(docs):
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(n):
    form, out = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
        out[w] = len(others)
    rows = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows[w] = (form[w], root, n[w], out[w], n[form[w]] if form[w] else None)
    return rows


def result(df):
    rows = df.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def made_up(rng):
    """Words in families of one or two edits, anagrams, repeated letters and wide counts."""
    n = {}
    for _ in range(60):
        base = "".join(rng.choice("abceéÿ") for _ in range(rng.randint(5, 9)))
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                k = rng.randrange(len(w))
                w[k:k + rng.randint(0, 1)] = [rng.choice("abceéÿ") for _ in range(rng.randint(0, 1))]
            w = "".join(w if rng.random() < 0.8 else rng.sample(w, len(w)))
            if len(w) >= 5:
                n[w] = rng.choice([3, 5, 6, 12, 24, 50, 100, 201])
    return n


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, seed):
    n = made_up(random.Random(seed))
    want = brute(n)
    assert result(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"))) == want
    assert max(len({w for w, r in want.items() if r[1] == root}) for root in {r[1] for r in want.values()}) > 3


def test_chain_of_forms(spark):
    """Each word leads to the next, so the root is many steps away."""
    words = ["a" * i + "b" * (40 - i) for i in range(41)]
    n = {w: 3 * 2 ** i for i, w in enumerate(words)}
    got = result(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert all(r[1] == words[-1] for r in got.values())


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(QUERIES["op13_spelling_variants"](spark, SF)) == brute(brute_words(docs))


def test_defined_cases(spark):
    run = lambda rows: result(spelling.variants(spelling.vocabulary(spelling.word_counts(rows))))
    assert run(frame(spark, [])) == {}
    docs = [(r[0], r[1]) for r in awkward_rows()]
    assert run(frame(spark).withColumnsRenamed({"lang": "word", "source": "n"})) == brute(brute_words(docs))
    assert run(frame(spark, [(None, "Über ÜBER über straße STRASSE " * 4 + "x" * 30_000, None, None, None)] * 3)) == brute(
        brute_words([(None, "Über ÜBER über straße STRASSE " * 4 + "x" * 30_000)] * 3))


def test_near_words_writes_no_pairs(spark, monkeypatch):
    """Near words are found in one pass over two written tables, the vectors and their signatures."""
    from clickwell.llm import spelling
    writes, write = [], spelling.write_shared
    monkeypatch.setattr(spelling, "write_shared", lambda df: writes.append(df.columns) or write(df))
    words = spark.createDataFrame([(w, "".join(sorted(w))) for w in ("letter", "lettér", "lette", "other")], "word string, letters string")
    got = sorted((r.word, r.other) for r in spelling.near_words(words).collect())
    assert got == sorted([("letter", "lettér"), ("lettér", "letter"), ("letter", "lette"), ("lette", "letter")])
    assert len(writes) == 2

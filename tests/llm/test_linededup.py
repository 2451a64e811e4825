import random
from hashlib import sha256

import pytest
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from clickwell.llm.linededup import _segments, _signature, dedup_lines, within
from clickwell.llm.queries import QUERIES
from helpers import awkward_rows, frame, prose, union_find


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("abé", max_size=25), st.lists(st.tuples(st.integers(0, 24), st.sampled_from(["del", "ins", "sub"]), st.sampled_from("abcé")), max_size=5),
       st.integers(0, 4))
def test_banded_distance_equals_table(a, edits, tau):
    b = a
    for at, kind, c in edits:
        at = min(at, len(b))
        b = b[:at] + ("" if kind == "del" else c) + b[at + (kind != "ins"):]
    assert within(a, b, tau) == (distance(a, b) <= tau or max(len(a), len(b)) <= tau)


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_near_lines_always_share_a_segment(tau):
    rng = random.Random(tau)
    for _ in range(400):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(24, 40)))
        b = list(a)
        for _ in range(rng.randint(0, tau)):
            at = rng.randrange(len(b))
            b[at:at + rng.randint(0, 1)] = rng.choice([[], ["c"], ["a"]])
        a, b = sorted([a, "".join(b)], key=len)
        if distance(a, b) > tau or a == b:
            continue
        index = {(seed, a[s:e]) for s, e, seed, role in _signature(len(a), tau) if role == 0}
        assert any((seed, b[s:e]) in index for s, e, seed, _ in _signature(len(b), tau))
    assert sum(size for _, size in _segments(41, tau)) == 41


def brute(rows, tau, min_chars, most):
    lines = [(i, n, x.strip(" \t\n\x0b\f\r")) for i, t in rows for n, x in enumerate((t or "").split("\n"))]
    lines = sorted(x for x in lines if len(x[2]) >= min_chars)
    find, link = union_find(len(lines))
    for i in range(len(lines)):
        for j in range(i):
            a, b = lines[i][2], lines[j][2]
            if abs(len(a) - len(b)) <= tau and distance(a, b) <= tau:
                link(i, j)
    gone = {lines[i][:2] for i in range(len(lines)) if find(i) != i}
    out = {}
    for i, t in rows:
        all_lines = (t or "").split("\n")
        cut = [n for n in range(len(all_lines)) if (i, n) in gone]
        whole = sum(len(all_lines[n]) for n in cut) > most * len(t or "")
        out[i] = t if whole else "\n".join(x for n, x in enumerate(all_lines) if n not in cut)
    return out


@pytest.mark.parametrize("tau", [0, 1, 2])
def test_equals_brute_force(spark, tau):
    rng = random.Random(4)
    stock = [prose(rng, rng.randint(4, 9)) for _ in range(25)]
    rows = []
    for i in range(50):
        lines = []
        for _ in range(rng.randint(1, 6)):
            x = list(rng.choice(stock) if rng.random() < 0.5 else prose(rng, 6))
            for _ in range(rng.randint(0, 3)):
                x[rng.randrange(len(x)):][:1] = []
                x[rng.randrange(len(x))] = rng.choice("xyz")
            lines.append(rng.choice(["", " ", "\t"]) + "".join(x))
        rows.append((i, "\n".join(lines)))
    rows += [(50, rows[0][1]), (51, "short\nshort"), (52, "")]
    got = {r.doc_id: r.text for r in dedup_lines(frame(spark, [(i, t, None, None, 0) for i, t in rows]).repartition(4), tau=tau).collect()}
    assert got == brute(rows, tau, 24, 0.5)


def test_defined_cases(spark):
    docs = frame(spark).withColumnsRenamed({"lang": "numbers", "source": "key"})
    got = dedup_lines(docs, stats="counts")
    assert got.columns == docs.columns + ["counts"] and got.count() == len(awkward_rows())
    by_id = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert by_id[1].text is None and by_id[4].text == ""
    assert by_id[19].text == by_id[16].text and by_id[19].counts.n_repeated == 1 and by_id[19].counts.n_removed == 0
    assert by_id[34].text == "a\n\n\nb\nb\nb"
    assert dedup_lines(frame(spark, [])).count() == 0


def patchwork():
    """Documents 0 to 3 are their own, 4 holds one passage of each, 5 is a copy of 0, 6
    repeats its own line, 7 has the passages of 4 and a line of its own."""
    rng = random.Random(11)
    rows = [(i, "\n".join(prose(rng, 12) for _ in range(4))) for i in range(4)]
    rows.append((4, "\n".join(rows[i][1].split("\n")[i] for i in range(4)) + "\nits own"))
    rows.append((5, rows[0][1]))
    own = prose(rng, 12)
    rows.append((6, "\n".join([own] * 4)))
    rows.append((7, rows[4][1].replace("its own", prose(rng, 3))))
    return [(i, t, None, None, len(t)) for i, t in rows]


def test_query_cuts_every_repeated_line(spark, scratch):
    frame(spark, patchwork()).write.parquet(f"{scratch}/cut/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op9_line_dedup"](spark, f"{scratch}/cut").collect()}
    assert all(r.n_removed == r.n_repeated for r in got.values())
    assert [got[i].n_removed for i in range(8)] == [0, 0, 0, 0, 4, 4, 3, 4]


def test_pipeline_leaves_only_copies_that_the_join_drops(spark):
    rows = {i: t for i, t, *_ in patchwork()}
    cut = corpus_pipeline.line_dedup(spark, frame(spark, patchwork()), None)
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[4] == "its own" and texts[6] == rows[6].split("\n")[0] and texts[7] == rows[7].split("\n")[4]
    assert texts[5] == rows[5] and 5 not in {r.doc_id for r in corpus_pipeline.near_duplicates(spark, cut, None).collect()}


def test_query_cuts_repeated_lines_of_every_length(spark, scratch):
    rows = [(1, "Menu\n\n  a line of its own, one of many\n}"), (2, "x\n Menu \n\nMenus\n}"), (3, None), (4, "Menu")]
    frame(spark, [(i, t, None, None, 0) for i, t in rows]).write.parquet(f"{scratch}/short/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op9_line_dedup"](spark, f"{scratch}/short").collect()}
    assert {i: (r.n_repeated, r.n_removed) for i, r in got.items()} == {1: (0, 0), 2: (2, 2), 3: (0, 0), 4: (1, 1)}
    assert got[2].kept_sha256 == sha256(b"x\n\nMenus").hexdigest()

import hashlib
import random
from itertools import combinations

from pyspark.sql import functions as F

from clickwell.llm import fingerprints
from clickwell.llm.queries import QUERIES
from helpers import VOCAB, awkward_rows, frame, prose


def test_edited_texts_and_neighbours(spark, scratch):
    rng = random.Random(5)
    rows = [(i * 7, prose(rng, rng.randint(0, 200)), "en", "s", 0) for i in range(80)] + [(3, None, None, None, None)]
    frame(spark, rows).repartition(6).write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op1_simhash"](spark, scratch).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for (i, t, *_), (j, u, *_) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        k = len(t) // 3
        edited = t[:len(t) - k] + u[:k]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = int(got[i].fingerprint, 16), int(got[i].edited_fingerprint, 16), int(got[j].fingerprint, 16)
        assert got[i].near_edited == 1 - (a ^ b).bit_count() / 128
        assert got[i].near_next == 1 - (a ^ c).bit_count() / 128
    big = [r for r in got.values() if r.n_chars > 200]
    assert sum(r.near_edited > r.near_next for r in big) >= 0.97 * len(big)


def test_votes_equal_brute_force(spark):
    text = "one two two three three three"
    terms = spark.range(1).select(F.explode(fingerprints.terms(F.lit(text))).alias("t")).select(
        "t", F.xxhash64("t").alias("hi"), F.xxhash64("t", F.lit(1)).alias("lo")).collect()
    assert len(terms) == 6 and [r.t & 15 for r in terms][:2] == [6, 6]
    want = []
    for half in ("hi", "lo"):
        bits = 0
        for k in range(64):
            vote = sum((r.t & 15) * (1 if r[half] >> k & 1 else -1) for r in terms)
            bits |= (vote > 0) << k
        want.append(bits)
    r = fingerprints.simhash(spark.createDataFrame([(1, text)], "id long, text string"), ["id"]).first()
    assert [r.hi & (1 << 64) - 1, r.lo & (1 << 64) - 1] == want


def test_awkward_rows(spark):
    docs = frame(spark).withColumnsRenamed({"lang": "bucket", "source": "place"})
    rows = fingerprints.edited_and_next(docs).collect()
    assert len(rows) == len(awkward_rows())
    by_id = {r.id: r for r in rows if r.id is not None}
    assert (by_id[1].hi, by_id[1].lo, by_id[1].n_chars) == (0, 0, 0)
    assert (by_id[16].hi, by_id[16].lo) == (by_id[19].hi, by_id[19].lo)
    assert fingerprints.edited_and_next(frame(spark, [])).count() == 0
    one = fingerprints.edited_and_next(frame(spark, [(5, "a b c d", None, None, None)])).first()
    assert (one.next_hi, one.next_lo) == (one.hi, one.lo)


def test_all_pairs_within_the_radius(spark):
    rng = random.Random(2)
    values = [rng.getrandbits(128) for _ in range(40)]
    values += [v ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, 5))) for v in values for _ in range(3)]
    s64 = lambda x: x - (1 << 64) if x >> 63 else x
    prints = spark.createDataFrame([(i, s64(v >> 64), s64(v & (1 << 64) - 1)) for i, v in enumerate(values)],
                                   "id long, hi long, lo long")
    least = {}
    for i, v in enumerate(values):
        least.setdefault(v, i)
    for radius, blocks in ((3, 6), (1, 2), (0, 4)):
        got = {(r.a, r.b, r.dist) for r in fingerprints.within_radius(prints, radius, blocks).collect()}
        want = {(min(i, j), max(i, j), (u ^ v).bit_count()) for (u, i), (v, j) in combinations(least.items(), 2)
                if (u ^ v).bit_count() <= radius}
        assert got == want


def test_neighbours_of_whole_texts(spark):
    """Classes and links by comparing all pairs of fingerprints."""
    rng = random.Random(9)
    bases = [prose(rng, 400) for _ in range(8)]
    texts = [b if k == 0 else b.replace(" ", "  ", k) if k == 1 else b + " " + rng.choice(VOCAB) * (k > 2) for b in bases for k in range(5)]
    docs = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, texts[0], None, None, None), (900, None, None, None, None)])
    got = fingerprints.neighbours(docs, radius=3).collect()
    assert len(got) == len(texts) + 2
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got if r.doc_id is not None}
    classes = {}
    for i in sorted(prints):
        classes.setdefault(prints[i], i)
    for r in got:
        if r.doc_id is None:
            assert r.class_id is None and r.n_links == 0
        else:
            p = prints[r.doc_id]
            assert r.class_id == classes[p]
            assert r.n_links == sum(0 < bin(p ^ q).count("1") <= 3 for q in classes)
    assert sum(r.n_links > 0 for r in got) > 4
    assert fingerprints.neighbours(frame(spark, [])).count() == 0


def test_neighbours_query_equals_brute_force(spark):
    got = QUERIES["simhash_neighbours"](spark, "/root/testdata/sf0.001").collect()
    prints = {}
    for r in sorted(got, key=lambda r: r.doc_id):
        prints.setdefault(int(r.fingerprint, 16), r.doc_id)
    for r in got:
        p = int(r.fingerprint, 16)
        assert r.class_id == prints[p]
        assert r.n_links == sum(0 < bin(p ^ q).count("1") <= 3 for q in prints)

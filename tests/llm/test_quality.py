import random

from pyspark.sql import functions as F

from clickwell.llm import quality
from helpers import awkward_rows, frame, prose, words


def brute(text):
    t = text or ""
    w = words(t)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    gone = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 3)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines), len(lines) - len(set(lines)), len(gone))


def test_measurements_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(0, 80), rng.sample(["a", "bb", "ccc", "#", "<é>", "東京", "\n", "\n\n", "x\ty"], 6))
             for _ in range(120)] + ["  a b", "a b c a b c", "a a a a", None, "", "\n\n"]
    docs = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words)
           for r in quality.ledger(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [brute(t) for t in texts]


def test_ledger_policies_and_ablations(spark):
    rows = quality.ledger(frame(spark)).cache()
    assert rows.count() == len(awkward_rows())
    kept = quality.apply_policy(rows, "web-1")
    assert kept.filter("kept").count() < quality.apply_policy(rows, "base-1").filter("kept").count()
    by_rule = {r.rule: r for r in quality.ablations(rows, "web-1").collect()}
    assert set(by_rule) == {r.name for r in quality.RULES}
    for rule in quality.RULES:
        without = quality.POLICIES["web-1"] & ~(1 << rule.bit)
        r = by_rule[rule.name]
        assert r.n_docs == rows.count()
        assert r.n_failed == rows.filter(F.expr(f"failures & {1 << rule.bit} <> 0")).count()
        assert r.n_kept_without == rows.filter(F.expr(f"failures & {without} = 0")).count()
        assert r.n_failed_alone == rows.filter(F.expr(f"failures & {quality.POLICIES['web-1']} = {1 << rule.bit}")).count()
    rows.unpersist()


def test_keep_leaves_columns_and_clean_documents(spark):
    docs = frame(spark).withColumnsRenamed({"lang": "n_words", "source": "failures"})
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {16, 19, 25, 40} <= ids and not ids & {1, 4, 7, 10, 22, 37, 43}
    assert quality.keep(frame(spark, [])).count() == 0 and quality.ledger(frame(spark, [])).count() == 0
    assert quality.ablations(quality.ledger(frame(spark, [])), "base-1").count() == 0


def test_ledger_plan_is_native_and_without_shuffle(spark):
    plan = quality.ledger(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickwell.llm import mixing
from helpers import awkward_rows, frame, prose

SF = "/root/testdata/sf0.01"


def load(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_expected_tokens_meet_targets(spark):
    docs = load(spark, "documents")
    rates = mixing.document_rates(docs, mixing.label_domains(docs, load(spark, "labels"))).collect()
    assert len(rates) == 1000 and all(r.rate >= 0 for r in rates)
    names = sorted(rates[0].posteriors)
    assert names == ["clean", "low", "toxic"]
    p = np.array([[r.posteriors[n] for n in names] for r in rates])
    t = np.array([r.tokens for r in rates])
    rate = np.array([r.rate for r in rates])
    assert np.allclose(p.sum(1), 1) and (t == [len((d.text or "").split()) for d in docs.collect()]).mean() > 0.9
    total = (rate * t) @ p
    before = t @ p
    want = np.array([mixing.WEIGHTS[n] for n in names]) / mixing.WEIGHTS["clean"] * before[0]
    assert np.abs(total - want).sum() <= 1e-3 * want.sum()


def test_rates_solve_the_least_squares_problem(spark):
    """Against long plain projected gradient descent on the same problem."""
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.4, 0.3, 0.3], 200)
    t = rng.integers(1, 500, 200)
    rows = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p)], "tokens long, p array<double>")
    weights = {"a": 0.7, "b": 0.25, "c": 0.05}
    steps = mixing.solve(rows, ["a", "b", "c"], weights, "a")
    rate = mixing._rates(p, steps)
    target = np.array([0.7, 0.25, 0.05]) / 0.7 * (t @ p)[0]
    plain = np.ones(200)
    m = (p * t[:, None]).T @ p
    for _ in range(5000):
        plain = np.maximum(0, plain - p @ ((plain * t) @ p - target) / np.linalg.eigvalsh(m)[-1])
    assert (rate >= 0).all()
    assert np.abs((rate * t) @ p - target).sum() <= max(1e-4 * target.sum(), 1.01 * np.abs((plain * t) @ p - target).sum())


def test_classifier_on_held_out_labels(spark):
    docs, labels = load(spark, "documents"), load(spark, "labels")
    rates = mixing.document_rates(docs, mixing.label_domains(docs, labels.filter("doc_id % 3 <> 0")))
    held = rates.join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    right = sum(max(r.posteriors, key=r.posteriors.get) == ("toxic" if r.toxic else "clean" if r.quality else "low") for r in held)
    assert right >= 0.85 * len(held)


def test_copies_have_the_rate_as_expectation(spark):
    r = spark.range(20_000).select(mixing.copies(F.lit(0.3), F.col("id")).alias("a"), mixing.copies(F.lit(1.25), F.col("id")).alias("b"))
    r = r.agg(F.avg("a").alias("a"), F.avg("b").alias("b"), F.min("b").alias("least")).first()
    assert abs(r.a - 0.3) < 0.02 and abs(r.b - 1.25) < 0.02 and r.least == 1


def test_defined_cases(spark):
    docs = frame(spark).withColumnsRenamed({"lang": "rate", "source": "tokens"})
    labelled = spark.createDataFrame([("alpha beta gamma", "clean"), ("x x x 1234 !!!", "low"), (None, "toxic")], "text string, domain string")
    got = mixing.document_rates(docs, labelled)
    assert got.count() == len(awkward_rows()) and got.filter("rate < 0 or rate is null").count() == 0
    assert got.filter("doc_id = 1").first().tokens == 0
    kept = mixing.mix(docs, labelled)
    assert kept.columns == docs.columns and kept.filter("doc_id is null").count() == 2
    nothing = labelled.limit(0)
    assert mixing.document_rates(docs, nothing).filter("rate <> 1").count() == 0
    assert mixing.mix(docs, nothing).count() == len(awkward_rows())
    assert mixing.mix(frame(spark, []), labelled).count() == 0
    assert mixing.document_rates(frame(spark, []), nothing).count() == 0


@pytest.mark.parametrize("toxic", [100, 300])
def test_domains_with_half_or_more_of_the_labels_are_told_apart(spark, toxic):
    """Balanced and toxic-heavy labels; one word of each text is found in its domain only."""
    rng = random.Random(toxic)
    marked = lambda n, word: [prose(rng, 20) + f" {word} " + prose(rng, 5) for _ in range(n)]
    rows = [(t, "clean") for t in marked(100, "gentle")] + [(t, "toxic") for t in marked(toxic, "vile")]
    labelled = spark.createDataFrame(rows, "text string, domain string")
    docs = spark.createDataFrame([(i, t, d) for i, (t, d) in enumerate(
        [(t, "clean") for t in marked(60, "gentle")] + [(t, "toxic") for t in marked(60, "vile")])], "doc_id long, text string, domain string")
    got = mixing.document_rates(docs, labelled, {"clean": 0.99, "toxic": 0.01}).join(docs, "doc_id").collect()
    assert all(max(r.posteriors, key=r.posteriors.get) == r.domain for r in got)
    seen = {d: sum(r.rate * r.tokens * r.posteriors[d] for r in got) for d in ("clean", "toxic")}
    assert abs(seen["toxic"] / seen["clean"] - 1 / 99) < 1e-3


def test_targets_that_cannot_be_met_are_reported(spark):
    rows = spark.createDataFrame([(100, [0.5, 0.5])] * 4, "tokens long, p array<double>")
    with pytest.warns(RuntimeWarning, match="targets not met"):
        mixing.solve(rows, ["clean", "toxic"], {"clean": 0.99, "toxic": 0.01}, "clean")
    docs = spark.createDataFrame([(1, "alpha beta")], "doc_id long, text string")
    labelled = spark.createDataFrame([("alpha beta", "clean")], "text string, domain string")
    with pytest.warns(RuntimeWarning, match="toxic"):
        mixing.document_rates(docs, labelled, {"clean": 0.99, "toxic": 0.01}).count()


def test_sums_as_columns_and_as_rows_are_the_same(spark, monkeypatch):
    rows = spark.createDataFrame([(10 * i, [i / 50, 1 - i / 50]) for i in range(50)], "tokens long, p array<double>").repartition(4)
    steps = [np.array([0.5, 0.1])]
    few = mixing._add_up(rows, steps, 2)
    monkeypatch.setattr(mixing, "WIDE", 0)
    many = mixing._add_up(rows, steps, 2)
    assert all(np.allclose(x, y, rtol=1e-12) for x, y in zip(few, many))
    assert all((x == 0).all() for x in mixing._add_up(rows.limit(0), steps, 2))

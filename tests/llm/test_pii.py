import random
import re

from pyspark.sql import functions as F

from clickwell.llm import pii
from helpers import awkward_rows, frame

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
         "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def base(docs):
    return {r.doc_id: r.s for r in pii.find(docs).select("doc_id", pii.listed(
        pii.of_kind(F.col("spans"), *pii.BASE)).alias("s")).collect()}


def test_base_spans_equal_plain_expressions(spark):
    rng = random.Random(5)
    pieces = ["1", "4111111111111111", " ", "-", ".", "@", "a", "b.c", "+1", "+4", "😀", "12", "0", "255", "256", "_",
              "x@y.z", "1.2.3.4", "é", "DE89 3704 0044 0532 0130 00", "123-45-6789 ssn "]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(rng.choice("a1.@+ -(é😀)234Z_%") for _ in range(rng.randint(0, 150))) for _ in range(500)]
    got = base(frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]))
    assert [got[i] for i in range(len(texts))] == [brute(t) for t in texts]
    assert sum(1 for s in got.values() if s) > 300


def test_long_runs_and_many_matches(spark):
    """Runs that a backtracking search would read again from every place, and more matches
    than one block of the running sums."""
    texts = ["a" * 200_000, "1" * 200_000, "a.b@c" + ".d" * 50_000, "1.2.3.4 " * 5000, "+1 " * 50_000, "a" * 100_000 + "@b"]
    got = base(frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]))
    assert got[0] == got[1] == got[4] == got[5] == ""
    assert got[2] == f"email:0:{len(texts[2])}"
    assert got[3] == ",".join(f"ip:{8 * i}:{8 * i + 7}" for i in range(5000))


def test_checksums_and_context(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00.", "IBAN DE88 3704 0044 0532 0130 00.", "my SSN is 123-45-6789",
             "number 123-45-6789", "SSN 000-45-6789", "SSN x123-45-6789", "ssn 987-65-4321 +1 123-45-6789"]
    docs = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find(docs).collect()}
    assert got[0] == [("iban", 5, 32)] and got[2] == [("ssn", 10, 21)]
    assert got[1] == got[3] == got[4] == got[5] == []
    assert [k for k, _, _ in got[6]] == ["phone"]   # what lies inside a base span is not found again
    scores = {r.doc_id: r.spans[0].score for r in pii.find(frame(spark, [
        (0, "8.8.8.8", None, None, None), (1, "the server 8.8.8.8", None, None, None)])).collect()}
    assert scores[1] > scores[0] >= pii.LEAST_SCORE


def test_redaction_and_defined_cases(spark):
    docs = frame(spark, [(1, "x😀 a.b@c.de, +1 (222) 555-1234 or 8.8.8.8", "en", None, None), (2, None, None, None, None),
                         (3, "", None, None, None), (None, "plain", None, None, None)])
    clash = docs.withColumnsRenamed({"lang": "spans", "source": "value"})
    out = pii.redact(clash)
    assert out.columns == clash.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "x😀 <EMAIL>, <PHONE> or <IP>", 2: None, 3: "", None: "plain"}
    assert pii.find(frame(spark)).count() == len(awkward_rows())
    assert pii.find(frame(spark, [])).count() == 0 and pii.redact(frame(spark, [])).count() == 0
    plan = pii.find(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan

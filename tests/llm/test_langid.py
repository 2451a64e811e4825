import zlib

from pyspark.sql import functions as F

from clickwell.llm import langid
from clickwell.llm.queries import QUERIES
from helpers import awkward_rows, frame

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = QUERIES["op3_language_mixture"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixture_shares(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    langs, model = langid.train(docs)
    assert langs == ["de", "en", "es", "fr"]
    best = docs.filter("n_chars > 2000").groupBy("lang").agg(F.max_by("text", "n_chars").alias("text")).collect()
    by = {r.lang: " ".join(r.text.split()[:300]) for r in best}
    mixed = by["de"] + " " + by["fr"]
    r = langid.predict(frame(spark, [(1, mixed, None, None, 0), (2, by["en"], None, None, 0)]), langs, model, ["doc_id"]).collect()
    m = {x.doc_id: x.mixture for x in r}
    assert 0.3 < m[1].get("de", 0) < 0.7 and 0.3 < m[1].get("fr", 0) < 0.7
    assert m[2].get("en", 0) > 0.9


def test_defined_cases(spark):
    docs = frame(spark).withColumnsRenamed({"source": "mixture"})
    langs, model = langid.train(docs)
    assert langs == ["de", "en"]
    got = langid.predict(docs, langs, model, ["doc_id", "n_chars"])
    assert got.count() == len(awkward_rows())
    by_id = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert all((by_id[i].lang_pred, by_id[i].score, by_id[i].mixture) == ("und", 0.0, {}) for i in (1, 4, 7, 43))
    assert by_id[10].lang_pred in langs
    none, empty = langid.train(frame(spark, []))
    assert none == [] and langid.predict(docs, none, empty, ["doc_id"]).filter("lang_pred <> 'und'").count() == 0
    assert langid.predict(frame(spark, []), langs, model, ["doc_id"]).count() == 0
    assert spark.range(1).select(langid.is_held_out(F.lit(None).cast("long"))).first()[0] is False

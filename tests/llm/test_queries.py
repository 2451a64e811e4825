"""The registered queries against their SQL, and the corpus pipeline stage by stage."""
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from clickwell.llm import mixing
from clickwell.llm.queries import ORACLE, QUERIES
from helpers import frame
from oracle_compare import compare, duck
from test_linededup import distance
from test_ngram_join import brute as ngram_classes
from test_packing import brute_best_fit

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    res = duck(SF).execute(ORACLE[name])
    assert compare([tuple(r) for r in df.collect()], df.columns, res.fetchall(), [d[0] for d in res.description]) is None


def test_all_and_the_pipeline_are_registered():
    names = E.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert names["pipeline"] is corpus_pipeline.run and "pipeline" not in E.oracle_sql()


def test_packing_query_has_the_tokenizer_s_ids(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall())
    got = QUERIES["op4_best_fit_packing"](spark, SF).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        ids = np.array(tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids + [1], "<u4")[r.start:r.start + r.length]
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
    assert len({r.sequence_id for r in got}) == len(brute_best_fit([r.length for r in got], 4096)[0])


def repeats(rows, tau=2, near_chars=24):
    """{(id, line number): (id, number) of the first line of its class} of the lines that
    repeat an earlier one, by comparing all pairs; character counts rule most pairs out."""
    lines = sorted((i, n, x.strip(" \t\n\x0b\f\r")) for i, t in rows for n, x in enumerate(t.split("\n")))
    lines = [x for x in lines if x[2]]
    first = {}
    for i, n, x in lines:
        first.setdefault(x, (i, n))
    different = sorted((x for x in first if len(x) >= near_chars), key=len)
    counts = [Counter(x) for x in different]
    parent = {x: x for x in first}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(different)):
        for b in range(a + 1, len(different)):
            x, y = different[a], different[b]
            if len(y) - len(x) > tau:
                break
            if sum((counts[a] - counts[b]).values()) <= tau and sum((counts[b] - counts[a]).values()) <= tau and distance(x, y) <= tau:
                parent[find(x)] = find(y)
    least = {}
    for x in first:
        least[find(x)] = min(least.get(find(x), first[x]), first[x])
    return {(i, n): least[find(x)] for i, n, x in lines if least[find(x)] != (i, n)}


def lines_cut_but_copies(rows):
    """The stage's rule: every repeat is cut, but a document that would lose more than half of
    its characters, most lines to another document, stays whole if it is a near copy (5 words,
    0.8) in a class whose first member is such another document, cut."""
    gone = repeats(rows)
    texts, cut, holder = dict(rows), {}, {}
    for i, t in rows:
        all_lines = t.split("\n")
        cut[i] = "\n".join(x for n, x in enumerate(all_lines) if (i, n) not in gone)
        mine = [gone[i, n][0] for n in range(len(all_lines)) if (i, n) in gone]
        chars = sum(len(x) for n, x in enumerate(all_lines) if (i, n) in gone)
        if 2 * chars > len(t):
            most = min(mine, key=lambda h: (-mine.count(h), h))
            holder |= {i: most} if most != i else {}
    some = {i: texts[i] if i in holder else cut[i] for i in {*holder, *holder.values()}}
    ids = sorted(some)
    classes = ngram_classes([some[i] for i in ids], 5, 80, 100)[1]
    copies = {i for i, c in zip(ids, classes) if i in holder and ids[c] not in holder}
    return {i: texts[i] if i in copies else cut[i] for i in texts}


def test_pipeline_stages(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages, tables = dict(corpus_pipeline.STAGES), {}
    assert list(stages) == ["quality_rules", "line_dedup", "near_duplicates", "mix_sources", "pack_sequences"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{scratch}/{name}")
        tables[name] = docs = spark.read.parquet(f"{scratch}/{name}")
        if name != "pack_sequences":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert docs.filter("n_chars <> length(text)").count() == 0
    texts = {name: {r.doc_id: r.text for r in t.collect()} for name, t in tables.items() if name != "pack_sequences"}

    con = duck(SF)
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLE['op6_quality_rules']}) WHERE kept").fetchall()}
    assert set(texts["quality_rules"]) == kept
    assert texts["line_dedup"] == lines_cut_but_copies(sorted(texts["quality_rules"].items()))
    ids = sorted(texts["line_dedup"])
    classes = ngram_classes([texts["line_dedup"][i] for i in ids], 5, 80, 100)[1]
    assert set(texts["near_duplicates"]) == {ids[c] for c in classes}
    labels = spark.read.parquet(f"{SF}/labels.parquet").selectExpr("doc_id", "1 as quality", "toxic").filter("toxic is not null")
    labelled = mixing.label_domains(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    rates = mixing.document_rates(tables["near_duplicates"], labelled, {"clean": 0.99, "toxic": 0.01})
    want = {r.doc_id: r.n for r in rates.select("doc_id", mixing.copies(F.col("rate"), F.col("doc_id")).alias("n")).collect() if r.n}
    assert Counter(r.doc_id for r in tables["mix_sources"].collect()) == want
    packed = tables["pack_sequences"].collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == want
    assert len({r.sequence_id for r in packed}) == len(brute_best_fit([r.length for r in packed], 4096)[0])


def test_no_name_of_a_column_is_in_the_way(spark):
    """Stages get every name that they use inside as a column of the input."""
    names = ("row id key numbers holder doubt chars cut hash n rate m ledger measured text_ component_id n_shingles size "
             "copy domain node tokens __text __key __cut __numbers __holder __n __id __copy __m spans").split()
    plain = frame(spark)
    docs = plain.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        want = Counter((r.doc_id, r.text) for r in stage(spark, plain, SF).collect())
        assert Counter((r.doc_id, r.text) for r in out.collect()) == want, name
        assert out.filter(" or ".join(f"`{c}` is null or `{c}` <> {k}" for k, c in enumerate(names))).count() == 0


def test_stages_on_empty_and_awkward_tables(spark):
    for rows in ([], None):
        docs = frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            n = out.count()
            assert n == 0 if rows == [] else n > 0, name
            if name != "pack_sequences":
                assert out.columns == docs.columns

"""A corpus pipeline from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes every stage's
table to the shared checkpoint folder before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickwell.llm import linededup, mixing, ngram_join, packing, quality
from clickwell.llm.common import table
from clickwell.llm.queries import tokenizer_path
from clickwell.session import write_shared


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the current web policy rejects."""
    return quality.keep(docs, "web-1")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that repeat an earlier line of the corpus, but for near copies of whole
    documents that the next stage is sure to drop; n_chars follows the text."""
    return linededup.dedup_lines_but_copies(docs, n=5, num=80, den=100, exact_chars=1).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five words, 0.8)."""
    return ngram_join.keep_one_of_each(docs, n=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that toxic text is one hundredth of the tokens.  The
    classifier learns from every document with a label of toxicity, whatever its quality."""
    labels = table(spark, sf_dir, "labels").filter("toxic is not null").select("doc_id", F.lit(1).alias("quality"), "toxic")
    labelled = mixing.label_domains(table(spark, sf_dir, "documents"), labels)
    return mixing.mix(docs, labelled, weights={"clean": 0.99, "toxic": 0.01})


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

ORACLE_SQL = None  # edit distance joins, classifier and tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

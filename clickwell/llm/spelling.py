"""Spelling variants of words, grouped around their commonest spelling (operator 13).

Words are counted over all documents.  Two words are near if they differ by one inserted,
deleted or replaced code point.  Near words are found by PartEnum signatures over letter
multisets: the letters of a word, numbered by occurrence (a second ``e`` is another
element than the first), are a binary vector.  A replaced letter changes two of its
elements, an inserted or deleted one changes one.  The elements are dealt to ``PARTS`` parts;
vectors that differ in two elements agree on all but at most two parts, so they share the
signature that leaves these two out (for one element: all but one part).  Every vector
enumerates its signatures, a fixed number, with its length; equal signatures meet in an
equi-join.  Pairs of vectors are made distinct, then the words of both are joined and
verified once by edit distance.

The join works on vectors, not on words: words of the same letters are one row, and they
are never near each other, so they are not compared.  Elements are dealt to the parts by
how evenly they split the vectors (the ``DEALT`` most telling ones in turn, the rest by
hash), which leaves few vectors to a signature: 49 at most among the 207,000 of half a GB of
documents.  The dealing changes how many candidates there are, never which pairs are found.
Signatures are hashes, so a collision adds a candidate and no more.

Words are counted in tasks, slice by slice of a few MB of text, and the counts are added up by
a hash aggregation with a map-side part: a word that fills a third of all documents is one
row a task.  Roots are found by pointer jumping over the words that have
a form; a form has at least ``lead`` times the count of its word, so chains are short
and the joins are few.

Defined cases: null and empty texts have no words; a null id counts as the empty id text;
repeated rows count as often as they are there; ties between forms go to the smaller word
in code-point order; no words give an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import write_shared
from .common import lower_ascii, slices

LETTER = "[A-Za-z\u00C0-\u00FF]"
#: parts of the element space; more parts make signatures finer and more numerous
PARTS = 8
#: elements dealt by their frequency; the rest are dealt by hash
DEALT = 1024
_MASK = (1 << 64) - 1


def _counts(min_length: int, every: int):
    long_runs = re.compile(f"{LETTER}{{{min_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                seen: dict[str, int] = {}
                for doc_id, text in zip(part.column("id").to_pylist(), lower_ascii(part.column("text")).to_pylist()):
                    start = crc32(f"{doc_id}:".encode())
                    for word, n in Counter(long_runs.findall(text)).items():
                        h = crc32(word.encode(), start)
                        if h % every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                        seen[word] = seen.get(word, 0) + n
                yield pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())}, schema=pa.schema(
                    [("word", pa.string()), ("n", pa.int64())]))

    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, every: int = 97) -> DataFrame:
    """(word, n): the runs of at least ``min_length`` letters of all texts, A-Z lower-cased, less one
    code point where ``every`` divides the checksum of id and run.  Counts of a few MB of text
    at a time; a word has a row for each, to be added up."""
    return docs.filter(F.col(f"`{text_col}`").isNotNull()).select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        _counts(min_length, every), "word string, n long")


def vocabulary(words: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """(word, n) of the words (word, n) that are long and common enough."""
    return (words.filter(F.length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= min_count))


def _elements(letters: str) -> list[tuple[str, int]]:
    """The elements of a vector; ``letters`` is sorted."""
    out, last, k = [], None, 0
    for c in letters:
        k = k + 1 if c == last else 0
        last = c
        out.append((c, k))
    return out


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "big")


def _dealing(vectors: DataFrame) -> dict[tuple[str, int], int]:
    """Part of the elements that split the vectors best (near half of them), dealt in turn."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[tuple[str, int], int] = {}
            for letters in batch["letters"]:
                for e in _elements(letters):
                    seen[e] = seen.get(e, 0) + 1
            yield pd.DataFrame([(c, k, n) for (c, k), n in seen.items()], columns=["c", "k", "n"])

    per = vectors.mapInPandas(count, "c string, k int, n long").groupBy("c", "k").agg(F.sum("n").alias("n"))
    half = per.crossJoin(F.broadcast(vectors.agg(F.count(F.lit(1)).alias("all"))))  # one row
    telling = half.orderBy(F.least("n", F.col("all") - F.col("n")).desc(), "c", "k").limit(DEALT).collect()
    turn = list(range(PARTS)) + list(range(PARTS - 1, -1, -1))
    return {(r.c, r.k): turn[i % (2 * PARTS)] for i, r in enumerate(telling)}


def _signatures(vectors: DataFrame, dealt: dict[tuple[str, int], int]) -> DataFrame:
    """(sig, side, letters): the signatures of every vector.  Side 0 meets vectors of its own
    length, side 1 (shorter) meets side 2 (longer by one)."""
    pairs = list(combinations(range(PARTS), 2))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes: dict[tuple[str, int], tuple[int, int]] = {}
        for batch in batches:
            sig, side, of = [], [], []
            for letters in batch["letters"]:
                parts = [0] * PARTS
                for e in _elements(letters):
                    known = hashes.get(e)
                    if known is None:
                        h = _hash(f"{e[1]}{e[0]}")
                        known = (dealt.get(e, h % PARTS), h)
                        if len(hashes) < 100_000:
                            hashes[e] = known
                    parts[known[0]] += known[1]
                # a part's share depends on its number, so their sum is a hash of all parts
                share = [((p ^ (p >> 29)) * (0x9E3779B97F4A7C15 + 2 * k) + (p >> 7)) & _MASK for k, p in enumerate(parts)]
                whole, size = sum(share), len(letters)
                for i, j in pairs:
                    sig.append(hash((0, size, i, j, (whole - share[i] - share[j]) & _MASK)))
                    side.append(0)
                for k in range(PARTS):
                    rest = (whole - share[k]) & _MASK
                    sig += (hash((1, size, k, rest)), hash((1, size - 1, k, rest)))
                    side += (1, 2)
                of += [letters] * (len(pairs) + 2 * PARTS)
            yield pd.DataFrame({"sig": sig, "side": side, "letters": of})

    return vectors.mapInPandas(sign, "sig long, side int, letters string")


def near_words(words: DataFrame) -> DataFrame:
    """(word, other) for every two near words, in both directions.  ``words`` has the columns
    ``word`` (distinct, not null) and ``letters`` (its sorted letters)."""
    vectors = write_shared(words.select("letters").distinct())
    signed = write_shared(_signatures(vectors, _dealing(vectors)))
    a = signed.filter("side < 2").select("sig", "side", F.col("letters").alias("a"))
    b = signed.filter("side <> 1").select("sig", F.col("letters").alias("b"))
    alike = a.join(b, "sig").filter("side = 1 or a < b").select("a", "b").distinct()
    first = alike.join(words.select(F.col("letters").alias("a"), "word"), "a").select("b", "word")
    second = words.select(F.col("letters").alias("b"), F.col("word").alias("other"))
    found = first.join(second, "b").filter(F.levenshtein("word", "other", 1) == 1)
    return found.select(F.explode(F.array(F.struct("word", "other"), F.struct(F.col("other").alias("word"), F.col("word").alias("other"))))
                        .alias("pair")).select("pair.*")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form; chains of forms have no loops."""
    now = write_shared(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = write_shared(now.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"),
                                                                    F.col("beyond").isNotNull().alias("moved")))
        now = step.drop("moved")
        if step.filter("moved").isEmpty():
            return now


def variants(vocab: DataFrame, lead: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n): ``form`` is the near
    word of largest count, if that is at least ``lead`` times the word's own."""
    words = write_shared(vocab.select("word", "n", F.array_join(F.array_sort(F.split("word", "")), "").alias("letters")))
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = (near_words(words.select("word", "letters")).join(counts, "other")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                 F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")))
    led = F.when(-F.col("best.less") >= lead * F.col("n"), F.col("best"))
    judged = write_shared(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        led["other"].alias("form"), (-led["less"]).alias("form_n")))
    roots = _roots(judged.filter("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

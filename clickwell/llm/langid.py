"""Language identification by multilingual mixture inference (operator 3).

A text may mix languages.  Each language has a distribution over byte n-grams (n = 3,
within words padded with blanks); the model of a document is a mixture of languages, one
per word, with proportions of its own (after Lui, Lau and Baldwin 2014):

    p(word) = sum over languages l of  share[l] * product of p(n-gram | l) over the word

Expectation-maximisation estimates the shares.  The set of languages is selected by
penalised likelihood: starting from the full mixture, nested sets of its largest shares
are refitted, and the set with the largest  log-likelihood - penalty * (k - 1) * ln(words)
is taken.  The prediction is the language with the largest share in that set, and the
score is this share.

Training counts the n-grams of every labelled row in one pass (summed per task, then
over the tasks); a model is ``2 ** BITS`` cells per language, whatever the corpus.
Prediction is a map over the rows.

Defined cases: null text, or a text without a letter, is ``und`` with score 0, as is
every text when there is nothing to learn from; rows without a label or an id are not
learned from; ties go to the first language in alphabetical order; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices, split_words

BITS = 18
ROUNDS = 8
REFITS = 3
PENALTY = 2.0
UNKNOWN = "und"
#: the n-gram counts of so many languages fit a model; more is an input error
MOST_LANGUAGES = 256


def _cells(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cell of every 3-byte n-gram of the words, each padded with a blank on both sides,
    and each word's offset into them (a word of n bytes has n n-grams)."""
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(sizes):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")
    data = np.frombuffer(joined.buffers()[2], np.uint8)[:int(sizes.sum()) + len(sizes) - 1]
    data = np.concatenate([[32], data, [32]]).astype(np.uint32)
    gram = data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)
    cell = (gram * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    middle = data[1:-1] != 32  # n-grams are centred on a word's bytes
    return cell[middle].astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])


def _lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts, ""))


def _count(cells_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        held: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                langs = part.column("lang").dictionary_encode()
                codes = langs.indices.to_numpy()
                for code, lang in enumerate(langs.dictionary.to_pylist()):
                    cells = cells_of(part.column("text").filter(pa.array(codes == code)))
                    counts[lang] = counts.get(lang, 0) + np.bincount(cells, minlength=1 << BITS)
                    held[lang] = held.get(lang, 0) + int((codes == code).sum())
        yield _as_batch(counts, held)
    return run


def _as_batch(counts: dict[str, np.ndarray], held: dict[str, int]) -> pa.RecordBatch:
    packed = [pa.compress(c.astype(np.int64).tobytes(), "zstd", asbytes=True) for c in counts.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(packed, pa.binary()),
                                       pa.array([held[x] for x in counts], pa.int64())],
                                      names=["lang", "counts", "held"])


def _gram_cells(texts: pa.Array) -> np.ndarray:
    return _cells(split_words(_lower(texts))[0])[0]


def _unpack(counts: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(counts, 8 << BITS, "zstd", asbytes=True), np.int64)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    held: dict[str, int] = {}
    for batch in batches:
        for lang, counts, n in zip(*[batch.column(c).to_pylist() for c in ("lang", "counts", "held")]):
            total[lang] = total.get(lang, 0) + _unpack(counts)
            held[lang] = held.get(lang, 0) + n
    yield _as_batch(total, held)


def count_cells(labelled: DataFrame, text_col: str, label_col: str, cells_of) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Labels in alphabetical order, the counts of their cells and their numbers of rows,
    over every row with a text and a label.  ``cells_of`` maps texts to cells."""
    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("lang")).filter(
        "text is not null and lang is not null")
    schema = "lang string, counts binary, held long"
    per_task = rows.mapInArrow(_count(cells_of), schema)
    found = per_task.repartition("lang").mapInArrow(_add, schema).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels")
    by_label = {r.lang: (_unpack(r.counts), r.held) for r in found}
    labels = sorted(x for x, (counts, _) in by_label.items() if counts.any())
    counts = np.array([by_label[x][0] for x in labels], np.int64).reshape(len(labels), 1 << BITS)
    return labels, counts, np.array([by_label[x][1] for x in labels], np.int64)


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in alphabetical order and their log n-gram probabilities."""
    langs, counts, _ = count_cells(labelled, text_col, lang_col, _gram_cells)
    totals = counts.sum(1, keepdims=True)
    return langs, np.log((counts + 0.5) / (totals + 0.5 * (1 << BITS))).astype(np.float32)


def _mixtures(like: np.ndarray, best: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the selected languages per document, and the number selected.  like: words
    x languages, each row divided by its largest, whose log is ``best``; offsets: of the
    documents' words, none empty."""
    k = like.shape[1]
    n = np.diff(offsets).astype(np.float32)
    of = np.repeat(np.arange(len(n)), np.diff(offsets))

    def refit(share: np.ndarray, rounds: int) -> np.ndarray:
        for _ in range(rounds):
            part = like * share[of]
            part /= np.maximum(part.sum(1, keepdims=True), 1e-30)
            share = np.add.reduceat(part, offsets[:-1], axis=0) / n[:, None]
        return share

    def log_likelihood(share: np.ndarray) -> np.ndarray:
        return np.add.reduceat(np.log(np.maximum((like * share[of]).sum(1), 1e-30)) + best, offsets[:-1])

    full = refit(np.full((len(n), k), 1 / k, np.float32), ROUNDS)
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
    chosen, score, size = full, np.full(len(n), -np.inf), np.zeros(len(n), int)
    for m in range(1, k + 1):
        share = np.where(rank < m, full + 1e-6, 0).astype(np.float32)
        share /= share.sum(1, keepdims=True)
        if m > 1:
            share = refit(share, REFITS if m < k else 0)
        now = log_likelihood(share) - PENALTY * (m - 1) * np.log(n + 1)
        better = now > score
        chosen = np.where(better[:, None], share, chosen)
        score, size = np.where(better, now, score), np.where(better, m, size)
    return chosen, size


def _has_letter(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def _predict(langs: list[str], model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.value.T.copy() if langs else None  # cells x languages
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                rows = part.num_rows
                pred, score = np.full(rows, UNKNOWN, object), np.zeros(rows)
                shares = np.zeros((rows, len(langs)))
                texts = part.column("text")
                use = np.flatnonzero(_has_letter(texts)) if langs else np.zeros(0, int)
                if len(use):
                    words, offsets = split_words(_lower(texts.take(pa.array(use))))
                    cells, at = _cells(words)
                    like = np.add.reduceat(table[cells], at[:-1], axis=0)
                    best = like.max(1)
                    like = np.exp(like - best[:, None])
                    found, _ = _mixtures(like, best, offsets)
                    top = found.argmax(1)
                    pred[use] = np.array(langs, object)[top]
                    score[use] = np.clip(found[np.arange(len(use)), top], 0, 1)
                    shares[use] = found
                mixture = [[(x, float(s)) for x, s in zip(langs, row) if s > 0] for row in shares]
                yield pa.RecordBatch.from_arrays([
                    *[part.column(c) for c in part.schema.names if c != "text"],
                    pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                    pa.array(mixture, pa.map_(pa.string(), pa.float64()))],
                    names=[c for c in part.schema.names if c != "text"] + ["lang_pred", "score", "mixture"])
    return run


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` with lang_pred, score and mixture (language to share)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 1 MB a language
    rows = docs.select(*keep, F.col(text_col).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(_predict(langs, shared), f"{schema}, lang_pred string, score double, mixture map<string,double>")


def is_held_out(id_col: Column) -> Column:
    """The fold of a row: crc32 of the id as text, modulo 4, is 2 (null id: not held out)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))

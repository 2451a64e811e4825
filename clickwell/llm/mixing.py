"""Mixing documents to target weights with soft domain membership (operator 10).

A classifier learned from a table of labelled documents gives each document a
probability per domain.  Every document then gets a rate (how often it is to be seen),
so that the expected tokens per domain,

    sum over documents d of  rate[d] * tokens[d] * p[d][k],

match the target: weight[k] times the total that leaves the tokens of the ``anchor``
domain as they are.  The rates solve the nonnegative least squares problem by projected
gradient steps from rate 1.  In the variables sqrt(tokens) * rate and the residual norm
of the K x K matrix M = sum tokens p p', the Lipschitz constant is 1, so the step needs
no tuning:

    rate <- max(0, rate - p . inverse(M) residual)

Steps are first tried with the M of the documents whose rate is still positive, which is
longer where many rates are 0, and taken if the residual shrinks well.  A step needs K sums over all documents, and a document's rate follows from its
probabilities and the K numbers of each earlier step, so no rates are stored, shuffled
or collected while iterating; a lost task is simply computed again.  Targets that are not
met when the steps end, and weights of domains without labelled rows, give a warning.

The classifier is naive Bayes on what a document holds: its words (lower case, without
punctuation at the ends), the shapes of its words (signs after the last letter, capitals)
and threefold repeats, hashed to 2 ** 18 cells and counted over all labelled rows.  Only
cells that mark a domain say anything, by being there or not: those that at least
``LEAST_LIFT`` times as many of its documents have as of all other domains, and significantly
so (``LEAST_Z`` standard deviations).  The domains that a marking cell does not mark share one
rate of it; all other cells are taken as equally likely everywhere, so that the length or
language of a text does not count.  The domain's own documents are not in what it is compared
with, so a domain with most of the labelled rows can be marked too.

Defined cases: null or wordless text has the probabilities of a text without any telling
cell and no tokens; a domain without labelled rows takes no part, and without any for the anchor all
rates are 1; repeated rows and null ids get rates like others; no documents give no
rows; other columns are left alone.
"""

from __future__ import annotations

import string
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import write_shared
from .common import hash_strings, slices, split_words
from .langid import BITS, count_cells

#: target weights of the domains that the label table tells apart
WEIGHTS = {"clean": 0.95, "low": 0.04, "toxic": 0.01}
ANCHOR = "clean"
#: a cell marks a domain whose share of documents with it exceeds that of the others by so much
LEAST_Z = 5.0
LEAST_LIFT = 2.0
STRENGTH = 10.0
ROUNDS = 60
TOLERANCE = 1e-5
#: numbers that are added up as columns of one row
WIDE = 200
#: targets missed by more than this part of their sum are reported
LEAST_MET = 1e-3


def label_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, domain) of the labelled documents: toxic, low (quality 0) or clean.  Labels
    grow with the documents, so they are joined by a shuffle at every size."""
    marks = labels.select(F.col("doc_id").alias("__id"), F.expr(
        "case when toxic = 1 then 'toxic' when quality = 0 then 'low' when quality = 1 then 'clean' end").alias("domain"))
    return docs.select("doc_id", "text").join(marks.filter("domain is not null").hint("merge"), F.col("doc_id") == F.col("__id")).select(
        "text", "domain")


PUNCTUATION = string.punctuation


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell) of every distinct feature of every text, and the rows' numbers of words."""
    words, offsets = split_words(texts)
    counts = np.diff(offsets)
    coded = words.dictionary_encode()
    of, each = coded.indices.to_numpy(), coded.dictionary
    bare = pc.ascii_trim(each, PUNCTUATION)
    tail = pc.extract_regex(each, r"(?P<tail>[^\pL\pN]*)$").field("tail")
    capitals = pc.and_(pc.utf8_is_upper(bare), pc.greater(pc.utf8_length(bare), 1))
    shape = pc.binary_join_element_wise("shape", pc.cast(capitals, pa.string()), tail, " ")
    row = np.repeat(np.arange(len(texts)), counts)
    thrice = np.flatnonzero((of[2:] == of[1:-1]) & (of[2:] == of[:-2]) & (row[2:] == row[:-2]))
    cell = lambda values: (hash_strings(values) >> np.uint64(64 - BITS)).astype(np.int64)
    cells = [cell(pc.ascii_lower(bare))[of], cell(shape)[of], np.repeat(cell(pa.array(["thrice"])), len(thrice))]
    pairs = np.unique(np.concatenate([row, row, row[thrice]]) << BITS | np.concatenate(cells))
    return pairs >> BITS, pairs & ((1 << BITS) - 1), counts


def _document_cells(texts: pa.Array) -> np.ndarray:
    return _features(texts)[1]


def _log_ratios(counts: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts of documents per domain and cell: what a cell adds to a domain's log score
    where it is present, and the score of a document without any."""
    n = held.astype(float)[:, None]
    share = counts.sum(0) / n.sum()
    spread = np.sqrt(np.maximum(n * share * (1 - share) * (1 - n / n.sum()), 1e-12))
    rate = lambda x, rows: (x + STRENGTH * share) / (rows + STRENGTH)
    own, others = rate(counts, n), rate(counts.sum(0) - counts, n.sum() - n)
    telling = (counts - n * share >= LEAST_Z * spread) & (own >= LEAST_LIFT * others)
    rest = rate(np.where(telling, 0, counts).sum(0), np.where(telling, 0, n).sum(0))
    rest = np.where(telling.any(0), rest, share)
    own = np.where(telling, own, rest).clip(1e-9, 1 - 1e-9)
    share = share.clip(1e-9, 1 - 1e-9)
    absent = np.where(telling.any(0), np.log((1 - own) / (1 - share)), 0.0)
    present = np.where(telling.any(0), np.log(own / share), 0.0)
    return (present - absent).astype(np.float32), absent.sum(1)


def _posteriors(model, base: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.value
        for batch in batches:
            for part in slices(batch, "text"):
                row, cell, n = _features(part.column("text"))
                score = np.stack([np.bincount(row, weights=w[cell], minlength=part.num_rows) for w in table], axis=1) + base
                p = np.exp(score - score.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1], dtype=np.int32)), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([
                    *[part.column(c) for c in part.schema.names if c != "text"], pa.array(n, pa.int64()), lists],
                    names=[c for c in part.schema.names if c != "text"] + ["tokens", "p"])
    return run


def _rates(p: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    rate = np.ones(len(p))
    for v in steps:
        rate = np.maximum(0, rate - p @ v)
    return rate


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("p").flatten().to_numpy().reshape(batch.num_rows, -1)


def _sums(steps: list[np.ndarray], domains: int):
    """Per task: the expected tokens per domain at the current rates, and the matrices M of
    all documents and of those with a positive rate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, whole, active = np.zeros(domains), np.zeros((domains, domains)), np.zeros((domains, domains))
        for batch in batches:
            if batch.num_rows:
                p, t = _matrix(batch), batch.column("tokens").to_numpy().astype(float)
                rate = _rates(p, steps)
                total += (rate * t) @ p
                whole += (p * t[:, None]).T @ p
                active += (p * (t * (rate > 0))[:, None]).T @ p
        values = np.concatenate([total, whole.ravel(), active.ravel()])
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(np.array([0, len(values)], np.int32), values)], names=["x"])
    return run


def _add_up(rows: DataFrame, steps: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """K + 2 * K * K numbers.  A few are added up as columns, one partial sum a task; many as rows."""
    parts = rows.select("tokens", "p").mapInArrow(_sums(steps, k), "x array<double>")
    out = np.zeros(k + 2 * k * k)
    if len(out) <= WIDE:
        out += [x or 0.0 for x in parts.agg(*[F.sum(F.get("x", F.lit(i))).alias(f"x{i}") for i in range(len(out))]).first()]
    else:
        for i, x in parts.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum("x")).collect():
            out[i] = x
    return out[:k], out[k:k + k * k].reshape(k, k), out[k + k * k:].reshape(k, k)


def solve(rows: DataFrame, domains: list[str], weights: dict[str, float], anchor: str) -> list[np.ndarray]:
    """The steps whose replay gives the rates.  rows: tokens, p (in the order of domains)."""
    inverse = lambda m: np.linalg.pinv(m, rcond=1e-12, hermitian=True)
    now, whole, active = _add_up(rows, [], len(domains))
    share = np.array([weights.get(x, 0.0) for x in domains])
    at = domains.index(anchor)
    target = share / share[at] * now[at]
    error = lambda x: np.abs(x - target).sum()
    steps: list[np.ndarray] = []
    for _ in range(ROUNDS):
        if error(now) <= TOLERANCE * max(target.sum(), 1.0):
            break
        longer = steps + [inverse(active) @ (now - target)]
        found = _add_up(rows, longer, len(domains))
        if error(found[0]) > 0.7 * error(now):  # the longer step went too far
            longer = steps + [inverse(whole) @ (now - target)]
            found = _add_up(rows, longer, len(domains))
        moved = np.abs(found[0] - now).sum()
        steps, (now, _, active) = longer, found
        if moved <= TOLERANCE / 100 * max(target.sum(), 1.0):   # all rounds together would not move by the tolerance
            break
    if error(now) > LEAST_MET * max(target.sum(), 1.0):
        warnings.warn("targets not met, expected tokens (target): " + ", ".join(
            f"{d} {x:.0f} ({y:.0f})" for d, x, y in zip(domains, now, target)), RuntimeWarning, stacklevel=2)
    return steps


def _with_rate(steps: list[np.ndarray], domains: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _matrix(batch) if batch.num_rows else np.zeros((0, len(domains)))
            kept = [c for c in batch.schema.names if c != "p"]
            pairs = [list(zip(domains, row)) for row in p.tolist()]
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in kept], pa.array(_rates(p, steps)),
                pa.array(pairs, pa.map_(pa.string(), pa.float64()))], names=[*kept, "rate", "posteriors"])
    return run


def document_rates(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None,
                   anchor: str = ANCHOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, tokens (words), rate and posteriors (domain to probability) per row."""
    spark = docs.sparkSession
    weights = WEIGHTS if weights is None else weights
    if weights.get(anchor, 0) <= 0:
        raise ValueError("the anchor domain needs a positive weight")
    kind = docs.schema[id_col].dataType.simpleString()
    domains, counts, held = count_cells(labelled, "text", "domain", _document_cells)
    if not domains:
        domains, counts, held = [anchor], np.ones((1, 1 << BITS), np.int64), np.ones(1)
    missing = [x for x, w in weights.items() if w > 0 and x not in domains]
    if missing:
        warnings.warn(f"no labelled rows, so no target can be met: {', '.join(missing)}", RuntimeWarning, stacklevel=2)
    model, without = _log_ratios(counts, held)
    rows = write_shared(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _posteriors(spark.sparkContext.broadcast(model), np.log(held / held.sum()) + without),
        f"id {kind}, tokens long, p array<double>"))
    steps = solve(rows, domains, weights, anchor) if anchor in domains else []
    return rows.mapInArrow(_with_rate(steps, domains),
                           f"id {kind}, tokens long, rate double, posteriors map<string,double>").withColumnRenamed("id", id_col)


def copies(rate: Column, id_col: Column) -> Column:
    """A whole number of copies with the rate as expectation: the fraction is decided by a
    hash of the id, so a rate of 1 or more keeps a document for certain."""
    chance = F.expr("1.0D") * F.shiftrightunsigned(F.xxhash64(id_col, F.lit("copies")), 11) / F.lit(float(1 << 53))
    return F.floor(rate + chance).cast("int")


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``docs`` with each row repeated as often as its rate says (0 times: it goes).  Rows
    that repeat an id, and so a text, share one rate; a null id is kept once.  Texts meet
    their rates by a shuffle at every size; the input is one struct there, so that no name
    of its columns is in the way."""
    rates = document_rates(docs, labelled, weights).filter("doc_id is not null").groupBy("doc_id").agg(F.max("rate").alias("rate"))
    chosen = rates.select(F.col("doc_id").alias("id"), copies(F.col("rate"), F.col("doc_id")).alias("n")).filter("n > 0")
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    seen = rows.join(chosen.hint("merge"), "id").select("row", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return seen.select(*[F.col("row")[c].alias(c) for c in docs.columns]).unionByName(docs.filter("doc_id is null"))

"""Line dedup by a segment-partition edit join (operator 9).

A line repeats an earlier one if it is equal to it or within ``tau`` edits (insertions,
deletions, substitutions of code points).  Equal lines are grouped by a 128-bit digest;
near lines are found as in PassJoin (Li et al. 2011): of the ``tau + 1`` segments of a
line, one at least occurs unchanged, at a place near its own, in every line within
``tau`` edits.  Each distinct line sends its segments (the index of its length) and the
substrings that could match a segment of a line of its length or up to ``tau`` shorter
(the probe, with the multi-match-aware choice of places).  Rows meet by (length, segment
number, text); candidates are verified with a banded bit-parallel edit distance.

Lists of lines that share a segment are paired with their first member only; after the
links found so far are followed, members still in different components are paired with
each other if their signatures allow it.  So a group of n near lines makes about n
candidates and loses no link.  A signature is 64 bits, the parities of the counts of 64
classes of characters: an edit changes two of them at most, so lines within ``tau`` edits
differ in 2 * ``tau`` bits at most, and lines that differ in whole words rarely pass.

The texts of candidate lines are fetched in one more pass over the documents.  A bit
table of fixed size (``FILTER_BITS`` bits) tells which lines are worth sending; its
false hits cost a row and are gone after the join.

Of each class of lines (links followed all the way) the first occurrence, by (id, line
number), stays.  ``dedup_lines`` with ``most`` None cuts all others; with a number it leaves
a document whole of whose characters more than that share would go.
``dedup_lines_but_copies`` cuts all others too, but leaves a document whole that the
document join is sure to drop: one that is a near copy of a document it repeats.

Near lines are looked for among lines of ``min_chars`` code points or more (without white
space at the ends); equal lines among those of ``exact_chars`` or more, by default the same.

Defined cases: null text stays null; lines of fewer than ``exact_chars`` code points always
stay, and so do lines of white space alone; a null id keeps its lines, which are not compared;
ids are taken to name one text; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import write_shared
from .common import let, parallelism, slices
from .graph import components
from .ngram_join import similarity_classes

TAU = 2
MIN_CHARS = 24
MOST = 0.5
FILTER_BITS = 24
BLOCK = 1 << 15


# --- edit distance ---------------------------------------------------------------------

def within(a: str, b: str, tau: int) -> bool:
    """Whether the edit distance of a and b is at most tau.  Bit k of a column's vectors is
    row j - tau + k of the distance matrix, so each column costs a few operations on
    numbers of 2 * tau + 1 bits (Myers 1999, Hyyro 2003)."""
    if len(a) < len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if m - n > tau:
        return False
    if a == b or m <= tau:
        return True
    rows: dict[str, int] = {}
    for i, c in enumerate(a):
        rows[c] = rows.get(c, 0) | 1 << (i + tau)
    full = (1 << (2 * tau + 1)) - 1
    low = 1 << (2 * tau)
    vp, vn, score = full & ~((1 << tau) - 1), 0, tau
    slack = n - m + 2 * tau  # what the last row can still win back, and tau
    for j, c in enumerate(b):
        eq = rows.get(c, 0) >> j & full
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp & full
        d0 &= full
        if j < m - tau:
            score += not d0 & low
            if score > slack:
                return False
        else:
            row = 1 << (m - j - 1 + tau)
            score += bool(hp & row) - bool(hn & row)
        vp = (hn | ~(d0 >> 1 | hp)) & full
        vn = d0 >> 1 & hp
    return score <= tau


# --- segments and substrings -----------------------------------------------------------

def _segments(length: int, tau: int) -> list[tuple[int, int]]:
    short, longer = divmod(length, tau + 1)
    out, at = [], 0
    for i in range(tau + 1):
        size = short + (i >= tau + 1 - longer)
        out.append((at, size))
        at += size
    return out


@lru_cache(maxsize=100_000)
def _signature(length: int, tau: int) -> list[tuple[int, int, int, int]]:
    """(start, end, seed, role) of all index (0) and probe (1) substrings of a line."""
    out = [(p, p + size, length * 64 + i, 0) for i, (p, size) in enumerate(_segments(length, tau))]
    for delta in range(tau + 1):
        for i, (p, size) in enumerate(_segments(length - delta, tau)):
            first = max(p - i, p + delta - (tau - i))
            last = min(p + i, p + delta + (tau - i))
            out += [(s, s + size, (length - delta) * 64 + i, 1) for s in range(first, last + 1)
                    if 0 <= s and s + size <= length and not (delta == 0 and s == p)]
    return out


def _key(line: str) -> bytes:
    return blake2b(line.encode(), digest_size=16).digest()


def _number(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _lines(part: pa.RecordBatch, min_chars: int) -> Iterator[tuple[int, int, str, int]]:
    """(row, line number, stripped line, code points with white space) of every line that counts."""
    lists = pc.split_pattern(part.column("text"), "\n")
    whole = lists.flatten()
    bare = pc.ascii_trim_whitespace(whole)
    offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
    use = np.flatnonzero(pc.utf8_length(bare).to_numpy(zero_copy_only=False) >= min_chars)
    row = np.searchsorted(offsets, use, side="right") - 1
    at = pa.array(use)
    yield from zip(row.tolist(), (use - offsets[row]).tolist(), bare.take(at).to_pylist(),
                   pc.utf8_length(whole.take(at)).to_pylist())


def _occurrences(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [(r, n, _key(x), c) for r, n, x, c in _lines(part, min_chars)]
                row, number, key, chars = zip(*found) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([
                    part.column("id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()),
                    pa.array(key, pa.binary()), pa.array(chars, pa.int32())], names=["id", "number", "key", "chars"])
    return run


def _substrings(min_chars: int, tau: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = xxhash.xxh3_64_intdigest
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, lines = [], []
                for x in {x for _, _, x, _ in _lines(part, min_chars)}:
                    spec = _signature(len(x), tau)
                    tokens += [hashed(x[a:b].encode(), seed) & ~1 | role for a, b, seed, role in spec]
                    lines += [_number(_key(x))] * len(spec)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.array(tokens, np.uint64).view(np.int64)), pa.array(lines, pa.int64())],
                    names=["token", "line"])
    return run


def _with_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (token, line); a list is the rows of one token but for its last bit,
    index rows first.  Lists without an index row or with one member go; the others get
    their first member as pivot.  Keeps one row between batches."""
    head, last, sent = None, None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        token, line = batch.column("token").to_numpy(), batch.column("line").to_numpy()
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (line[1:] != line[:-1])
        new[0] = (token[0], line[0]) != last
        last = (token[-1], line[-1])
        token, line = token[new], line[new]
        if not len(token):
            continue
        goes_on = head is not None and head[0] >> 1 == token[0] >> 1
        if goes_on:
            token, line = np.concatenate([[head[0]], token]), np.concatenate([[head[1]], line])
        group = token >> 1
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        lengths = np.diff(np.append(starts, len(token)))
        good = (lengths > 1) & (token[starts] & 1 == 0)
        keep = np.repeat(good, lengths)
        pivot = np.repeat(line[starts], lengths)
        if goes_on and sent:
            keep[0] = False
        head, sent = (token[starts[-1]], line[starts[-1]]), bool(good[-1])
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(token[keep]), pa.array(line[keep]), pa.array(pivot[keep])],
                                             names=["token", "line", "pivot"])


def _parities(line: str) -> int:
    """Bit k: whether the characters of class k occur an odd number of times."""
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32)
    classes = (codes * np.uint32(2654435761)) >> np.uint32(26)
    return int(np.bitwise_xor.reduce(np.left_shift(np.uint64(1), classes.astype(np.uint64))).view(np.int64))


# --- a bit table of the lines whose texts are needed -----------------------------------

def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(1 << FILTER_BITS, bool)
    for batch in batches:
        table[batch.column("line").to_numpy() & ((1 << FILTER_BITS) - 1)] = True
    packed = np.packbits(table)
    filled = [i for i in range(0, len(packed), BLOCK) if packed[i:i + BLOCK].any()]
    yield pa.RecordBatch.from_arrays([pa.array([i // BLOCK for i in filled], pa.int32()),
                                      pa.array([packed[i:i + BLOCK].tobytes() for i in filled], pa.binary())],
                                     names=["block", "bits"])


def _or_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, bits in zip(batch.column("block").to_pylist(), batch.column("bits").to_pylist()):
            mine = np.frombuffer(bits, np.uint8)
            total[block] = total[block] | mine if block in total else mine
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                      pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                     names=["block", "bits"])


def _filter_of(lines: DataFrame) -> np.ndarray:
    """2 ** FILTER_BITS bits, whatever the number of lines."""
    packed = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    schema = "block int, bits binary"
    for block, bits in lines.mapInArrow(_bits, schema).repartition("block").mapInArrow(_or_blocks, schema).collect():
        packed[block * BLOCK:block * BLOCK + BLOCK] = np.frombuffer(bits, np.uint8)
    return np.unpackbits(packed).astype(bool)


def _wanted(min_chars: int, shared_filter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared_filter.value
        for batch in batches:
            for part in slices(batch, "text"):
                found = {}
                for x in {x for _, _, x, _ in _lines(part, min_chars)}:
                    key = _key(x)
                    if table[_number(key) & (len(table) - 1)]:
                        found[key] = x
                yield pa.RecordBatch.from_arrays([
                    pa.array([_number(k) for k in found], pa.int64()), pa.array(list(found), pa.binary()),
                    pa.array(list(found.values()), pa.string()),
                    pa.array([_parities(x) for x in found.values()], pa.int64())],
                    names=["line", "key", "body", "parities"])
    return run


def _near(tau: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("body_a").to_pylist(), batch.column("body_b").to_pylist()
            near = pa.array([within(x, y, tau) for x, y in zip(a, b)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("line_a", "line_b", "key_a", "key_b")] + [near],
                                             names=["line_a", "line_b", "key_a", "key_b", "near"])
    return run


def _verify(pairs: DataFrame, bodies: DataFrame, tau: int) -> DataFrame:
    side = lambda x: bodies.select(*[F.col(c).alias(f"{c}_{x}") for c in ("line", "key", "body", "parities")])
    return (pairs.join(side("a"), "line_a").join(side("b"), "line_b").filter(_may_be_near("parities_a", "parities_b", tau))
            .select("line_a", "line_b", "key_a", "key_b", "body_a", "body_b")
            .mapInArrow(_near(tau), "line_a long, line_b long, key_a binary, key_b binary, near boolean"))


def _may_be_near(a: str, b: str, tau: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= 2 * tau


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("line_a"), F.greatest(a, b).alias("line_b")]


def near_line_links(texts: DataFrame, tau: int = TAU, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key_a, key_b): verified links between different lines that between them connect
    every class of near lines.  texts: id, text."""
    spark = texts.sparkSession
    lists = write_shared(texts.mapInArrow(_substrings(min_chars, tau), "token long, line long")
                         .withColumn("list", F.expr("shiftright(token, 1)"))
                         .repartition(parallelism(spark), "list").drop("list").sortWithinPartitions("token", "line")
                         .mapInArrow(_with_pivot, "token long, line long, pivot long"))
    table = spark.sparkContext.broadcast(_filter_of(lists.select("line").unionByName(lists.select(F.col("pivot").alias("line")))))
    bodies = write_shared(texts.mapInArrow(_wanted(min_chars, table), "line long, key binary, body string, parities long")
                          .dropDuplicates(["key"]))
    star = lists.filter("line <> pivot").select(*_ordered("line", "pivot")).distinct()
    judged = write_shared(_verify(star, bodies, tau))
    part = components(judged.filter("near"), "line_a", "line_b").select(F.col("node").alias("line"), F.col("component").alias("part"))

    placed = (lists.select(F.expr("shiftright(token, 1)").alias("list"), F.expr("token & 1").alias("role"), "line")
              .join(part, "line", "left").withColumn("part", F.coalesce("part", "line")))
    split = placed.groupBy("list").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x <> y")
    rest = write_shared(placed.join(split.select("list"), "list", "left_semi")
                        .join(bodies.select("line", "parities"), "line"))
    probes = rest.select("list", F.col("line").alias("other"), F.col("part").alias("other_part"),
                         F.col("parities").alias("other_parities"))
    pairs = (rest.filter("role = 0").join(probes, "list").filter("part <> other_part")
             .filter(_may_be_near("parities", "other_parities", tau))
             .select(*_ordered("line", "other")).distinct()
             .join(judged.select("line_a", "line_b"), ["line_a", "line_b"], "left_anti"))
    more = _verify(pairs, bodies, tau)
    return judged.filter("near").unionByName(more.filter("near")).select("key_a", "key_b")


def repeated_lines(texts: DataFrame, tau: int = TAU, min_chars: int = MIN_CHARS, exact_chars: int | None = None) -> DataFrame:
    """(id, numbers, chars, holder): per document the numbers of its lines that repeat an
    earlier line, their code points, and the document that holds the first occurrences of
    most of them.  texts: id, text."""
    texts = texts.filter("id is not null and text is not null")
    found = write_shared(texts.mapInArrow(_occurrences(min_chars if exact_chars is None else max(1, min(exact_chars, min_chars))), "id long, number int, key binary, chars int"))
    part = components(near_line_links(texts, tau, min_chars), "key_a", "key_b")
    lines = found.groupBy("key").agg(F.min(F.struct("id", "number")).alias("first"), F.count("*").alias("n"))
    classes = lines.join(part, F.col("key") == F.col("node"), "left").withColumn("class", F.coalesce("component", "key"))
    near = classes.filter("component is not null")
    firsts = near.groupBy("class").agg(F.min("first").alias("class_first"))
    repeated = classes.join(firsts, "class", "left").filter("n > 1 or class_first <> first").select(
        "key", F.coalesce("class_first", "first").alias("keep"))
    return (found.join(repeated, "key").filter("not (keep.id = id and keep.number = number)")
            .groupBy("id").agg(F.sort_array(F.collect_set(F.struct("number", "chars"))).alias("at"),
                               F.mode("keep.id", True).alias("holder"))
            .select("id", F.col("at.number").alias("numbers"), "holder",
                    F.aggregate("at", F.lit(0).cast("long"), lambda s, x: s + x["chars"]).alias("chars")))


def _without(text: Column, numbers: Column, most: float | None = None) -> Column:
    """text, n_lines and n_removed of a text without the lines of these numbers (null: none);
    it stays whole where more than ``most`` of its code points would go."""
    def cut(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), numbers)
        whole = numbers.isNull()
        if most is not None:
            chars = F.aggregate(numbers, F.lit(0).cast("long"), lambda s, i: s + F.coalesce(F.length(F.get(lines, i)), F.lit(0)))
            whole = whole | (chars > F.lit(most) * F.length(text))
        return F.struct(F.when(whole, text).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")).alias("text"),
                        F.size(lines).cast("long").alias("n_lines"),
                        F.when(whole, F.lit(0)).otherwise(F.size(lines) - F.size(left)).cast("long").alias("n_removed"))
    return let(F.split(text, "\n"), cut)


def _nested(docs: DataFrame, id_col: str) -> DataFrame:
    """(row, id): the input in one struct, so that no name of its columns is in the way."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"))


def _by_id(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Left join on id, by a shuffle at every size; rows with a null id do not take part."""
    held = rows.filter("id is not null").join(facts.hint("merge"), "id", "left")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema.fields if f.name != "id"]
    return held.select(*rows.columns, *[c for c in facts.columns if c != "id"]).unionByName(
        rows.filter("id is null").select("*", *missing))


def _gone(docs: DataFrame, id_col: str, text_col: str, tau: int, min_chars: int, exact_chars: int | None = None) -> DataFrame:
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return repeated_lines(texts, tau, min_chars, exact_chars)


def _back(docs: DataFrame, text_col: str, text: Column) -> list[Column]:
    """The columns of ``docs`` out of ``row``, with another text."""
    return [text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = TAU,
                min_chars: int = MIN_CHARS, most: float | None = MOST, stats: str | None = None,
                exact_chars: int | None = None) -> DataFrame:
    """``docs`` with ``text_col`` without repeated lines; ``stats`` names an optional struct
    column n_lines, n_repeated (lines that repeat an earlier one), n_removed."""
    gone = _gone(docs, id_col, text_col, tau, min_chars, exact_chars).select("id", "numbers")
    done = _by_id(_nested(docs, id_col), gone).select("row", "numbers", _without(F.col("row")[text_col], F.col("numbers"), most).alias("cut"))
    out = _back(docs, text_col, F.col("cut.text"))
    if stats:
        out.append(F.struct(F.coalesce("cut.n_lines", F.lit(0)).cast("long").alias("n_lines"),
                            F.coalesce(F.size("numbers"), F.lit(0)).cast("long").alias("n_repeated"),
                            F.coalesce("cut.n_removed", F.lit(0)).cast("long").alias("n_removed")).alias(stats))
    return done.select(*out)


def dedup_lines_but_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = TAU,
                           min_chars: int = MIN_CHARS, most: float = MOST, n: int = 5, num: int = 80, den: int = 100,
                           exact_chars: int | None = None) -> DataFrame:
    """``docs`` with ``text_col`` without repeated lines, except documents that a join of near
    copies (``n`` words, ``num`` / ``den``) of the result drops.

    In doubt are documents of whose characters more than ``most`` would go, most lines to
    another document, the holder.  They, as they are, and the holders, cut, are joined.  A
    document in doubt stays whole if the first of its class is not in doubt: every member of
    the class is then in the result with the text it was joined with, so the join of the
    result finds the same links and drops it.  All others are cut.

    Who is in doubt follows from lengths alone.  The texts are joined with the lines to go
    once, by a shuffle at every size, and written; only those in doubt are joined again."""
    gone = write_shared(_gone(docs, id_col, text_col, tau, min_chars, exact_chars))
    sizes = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.length(F.col(f"`{text_col}`")).alias("size"))
    doubt = write_shared(gone.join(sizes.hint("merge"), "id").filter((F.col("chars") > F.lit(most) * F.col("size")) & (F.col("holder") != F.col("id")))
                         .select("id", "holder").distinct())
    roles = (doubt.select("id", F.lit(True).alias("doubt")).unionByName(doubt.select(F.col("holder").alias("id"), F.lit(False).alias("doubt")))
             .groupBy("id").agg(F.max("doubt").alias("doubt")))
    judged = write_shared(_by_id(_nested(docs, id_col), gone.select("id", "numbers").join(roles, "id", "full")))
    text = F.col("row")[text_col]
    cut = _without(text, F.col("numbers"))["text"]
    some = write_shared(judged.filter("doubt is not null").select("id", F.when(F.col("doubt"), text).otherwise(cut).alias("text"), "doubt")
                        .dropDuplicates(["id"]))
    classes = similarity_classes(some.select("id", "text"), id_col="id", n=n, num=num, den=den).select("id", "component_id")
    copies = (classes.join(some.filter("doubt").select("id"), "id", "left_semi")
              .join(some.filter("not doubt").select(F.col("id").alias("component_id")), "component_id", "left_semi")
              .select("id", F.lit(True).alias("copy")))
    clear = judged.filter("doubt is null or not doubt").select(*_back(docs, text_col, cut))
    unclear = _by_id(judged.filter("doubt"), copies).select(*_back(docs, text_col, F.when(F.col("copy"), text).otherwise(cut)))
    return clear.unionByName(unclear)

"""N-gram Jaccard join with rare-first prefix filtering (operator 2).

Two documents link when the Jaccard similarity of their sets of word n-grams is at
least ``num / den``.  The join follows prefix filtering with length, positional and
suffix filters (Bayardo et al. 2007; Xiao et al., PPJoin+, 2008):

1. One pass hashes every text to its set, a 128-bit digest of that set (the *node*:
   equal sets are one node, so copies cost one member) and counts how many documents
   hold each n-gram.  Counts go to a table of ``2 ** sketch_bits`` cells (4 MB by
   default, whatever the input), so that its broadcast has a fixed size.  Cells that
   several n-grams share only make the order less sharp; any total order gives the
   same links.
2. A second pass orders each set rare-first, by (cell count, hash), and sends only the
   prefix: ``size - ceil(t * size) + 1`` n-grams.  Similar sets share one of these.
3. Rows meet by n-gram.  Each posting list streams past in order of position, and
   every member is paired with the list's first member only, so a list of n members
   makes n candidates, not n * n.  Candidates pass the length, positional and suffix
   filters and are verified on the whole sets, once per pair.
4. Members of one posting list that are not yet in one component are then paired with
   each other (same filters, pairs already verified left out) and verified.  So no
   component is missed, and pairs inside a component are never listed.

Components come from the verified links (``graph.components``).

Defined cases: null or wordless text has an empty set and links with nothing; a text
with fewer than n words is one n-gram, its whole word sequence; a null id is returned
without links and with a null component; ids are taken to name one text (rows that
repeat an id are judged together); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import write_shared
from .common import (hash_strings, hash_windows, id_marks, lower_ascii, parallelism, signed, slices, split_words,
                     with_mark)
from .graph import components

SKETCH_BITS = 20
BLOCK = 1 << 14
BANDS = 16
HOT_MEMBERS = 20_000
#: text that a task hashes at a time, and blocks of counts that it sends at a time
PART_BYTES = 1 << 20
BLOCKS_SENT = 8

_FIRST_PASS = "id long, n_shingles long, node binary, bands array<int>, block int, counts binary"
_PREFIX = "token long, salt int, pos int, size int, node binary"
_POSTINGS = _PREFIX + ", pivot binary, pivot_pos int, pivot_size int"


def _sets(texts: pa.Array, n: int, lower: bool) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    flat, offsets = split_words(lower_ascii(texts) if lower else texts)
    words = hash_strings(flat)
    windows = hash_windows(words, n)
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= n:
            yield np.unique(windows[a:b - n + 1])
        else:
            yield hash_windows(words[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def _node(members: np.ndarray) -> bytes | None:
    return blake2b(members.tobytes(), digest_size=16).digest() if len(members) else None


def _cells(members: np.ndarray, bits: int) -> np.ndarray:
    return (members >> np.uint64(64 - bits)).astype(np.int64)


def _first_pass(n: int, lower: bool, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                sets = list(_sets(part.column("text"), n, lower))
                nodes = [_node(s) for s in sets]
                held = np.concatenate(sets)
                counts += np.bincount(_cells(held, bits), minlength=1 << bits)
                bands = [np.bincount((s >> np.uint64(60)).astype(np.int64), minlength=BANDS) for s in sets]
                k = part.num_rows
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int32())),
                    pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                    names=["id", "n_shingles", "node", "bands", "block", "counts"])
        filled = [i for i in range(0, len(counts), BLOCK) if counts[i:i + BLOCK].any()]
        for sent in (filled[i:i + BLOCKS_SENT] for i in range(0, len(filled), BLOCKS_SENT)):
            k = len(sent)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()),
                pa.nulls(k, pa.list_(pa.int32())), pa.array([i // BLOCK for i in sent], pa.int32()),
                pa.array([counts[i:i + BLOCK].astype(np.uint32).tobytes() for i in sent], pa.binary())],
                names=["id", "n_shingles", "node", "bands", "block", "counts"])
    return run


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            mine = np.frombuffer(counts, np.uint32).astype(np.int64)
            total[block] = total[block] + mine if block in total else mine
    for block, counts in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([counts.tobytes()], pa.binary())],
                                         names=["block", "counts"])


def _document_counts(first: DataFrame, bits: int) -> np.ndarray:
    """The summed cell counts: 2 ** bits numbers, whatever the input."""
    blocks = (first.filter("block is not null").select("block", "counts").repartition("block")
              .mapInArrow(_add_blocks, "block int, counts binary"))
    counts = np.zeros(1 << bits, np.int64)
    for block, part in blocks.collect():
        counts[block * BLOCK:block * BLOCK + BLOCK] = np.frombuffer(part, np.int64)
    return np.minimum(counts, np.iinfo(np.int32).max).astype(np.int32)


def _prefixes(n: int, lower: bool, bits: int, num: int, den: int, shared_counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared_counts.value
        hot = HOT_MEMBERS + 4 * int(counts.mean())
        for batch in batches:
            seen = set()
            for part in slices(batch, "text", PART_BYTES):
                tokens, places, sizes, nodes = [], [], [], []
                for members in _sets(part.column("text"), n, lower):
                    node = _node(members)
                    if node is None or node in seen:  # copies in one batch are sent once
                        continue
                    seen.add(node)
                    size = len(members)
                    length = size - -(-num * size // den) + 1
                    order = np.lexsort((members, counts[_cells(members, bits)]))[:length]
                    tokens.append(members[order])
                    places.append(np.arange(length, dtype=np.int32))
                    sizes.append(np.full(length, size, np.int32))
                    nodes += [node] * length
                if not tokens:
                    continue
                token = np.concatenate(tokens)
                count = counts[_cells(token, bits)].astype(np.int64)
                spread = np.frombuffer(b"".join(x[:4] for x in nodes), np.uint32).astype(np.int64)
                salt = np.where(count > hot, spread % (1 + count // hot), -1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(signed(token)), pa.array(salt.astype(np.int32)), pa.array(np.concatenate(places)),
                    pa.array(np.concatenate(sizes)), pa.array(nodes, pa.binary())],
                    names=["token", "salt", "pos", "size", "node"])
    return run


def _with_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (token, salt, pos, size, node): drop repeated members and lists of one
    member, and add each list's first member.  Keeps one row between batches."""
    head: pa.Table | None = None  # the first member of the list that may go on
    last: tuple | None = None  # token, salt, node of the last row
    sent = False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        token, salt = rows["token"].to_numpy(), rows["salt"].to_numpy()
        node = np.array(rows["node"].to_pylist(), object)
        again = np.zeros(len(token), bool)
        again[1:] = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1]) & (node[1:] == node[:-1])
        again[0] = last == (token[0], salt[0], node[0])
        last = (token[-1], salt[-1], node[-1])
        if again.any():
            rows = rows.filter(pa.array(~again))
            if not rows.num_rows:
                continue
        goes_on = head is not None and head["token"][0].as_py() == rows["token"][0].as_py() \
            and head["salt"][0].as_py() == rows["salt"][0].as_py()
        if goes_on:
            rows = pa.concat_tables([head, rows]).combine_chunks()
        token, salt = rows["token"].to_numpy(), rows["salt"].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])]))
        lengths = np.diff(np.append(starts, len(token)))
        keep = np.repeat(lengths > 1, lengths) | (salt >= 0)
        first = np.repeat(starts, lengths)
        if goes_on and sent:
            keep[0] = False
        sent = bool(lengths[-1] > 1 or salt[-1] >= 0)
        head = rows.slice(int(starts[-1]), 1)
        if keep.any():
            chosen = np.flatnonzero(keep)
            out, pivots = rows.take(chosen), rows.take(first[chosen])
            for name in ("node", "pos", "size"):
                out = out.append_column("pivot" if name == "node" else f"pivot_{name}", pivots[name])
            yield from out.combine_chunks().to_batches()


def _shared(n: int, lower: bool):
    """Rows a, b (nodes) with text_a, text_b: the number of shared n-grams.  A row whose
    text is not its node's (an id may name several texts) is left out."""
    def members(texts: pa.Array):
        coded = texts.dictionary_encode()  # a text in many pairs is hashed once
        sets = list(_sets(coded.dictionary, n, lower))
        nodes = [_node(s) for s in sets]
        for code in coded.indices.to_pylist():
            yield sets[code], nodes[code]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_b"):
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                rows = [(x, y, len(np.intersect1d(s, t, assume_unique=True)), len(s) + len(t))
                        for x, y, (s, u), (t, v) in zip(a, b, members(part.column("text_a")), members(part.column("text_b")))
                        if x == u and y == v]
                columns = list(zip(*rows)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([
                    pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()),
                    pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], names=["a", "b", "shared", "both"])
    return run


def _overlap_filters(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Length and positional filter on columns size, pos, size_b, pos_b: what is left of
    both sets after the shared n-gram bounds their overlap."""
    return pairs.filter(f"{num} * greatest(size, size_b) <= {den} * least(size, size_b) and "
                        f"{num} * (size + size_b) <= {num + den} * (1 + least(size - pos, size_b - pos_b) - 1)")


def _suffix_filter(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """Every set is cut at fixed places of the hash range; the differing counts of the
    pieces are n-grams that the two sets cannot share.  Adds the nodes' ids."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("bands").alias(f"bands_{x}"),
                                  F.col("n_shingles").alias(f"n_{x}"), F.col("id").alias(f"id_{x}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(f"({num + den}) * (n_a + n_b - aggregate(zip_with(bands_a, bands_b, (x, y) -> abs(x - y)), "
                    f"0, (s, x) -> s + x)) >= 2 * {num} * (n_a + n_b)")
            .select("a", "b", "id_a", "id_b"))


def _verify(pairs: DataFrame, texts: DataFrame, n: int, lower: bool, num: int, den: int) -> DataFrame:
    """Both joins read one exchange of the texts that are in a pair (and the few that share a mark with
    one); what travels besides is one text a pair."""
    paired = id_marks(pairs.select(F.explode(F.array("id_a", "id_b")).alias("id")))
    texts = with_mark(texts, paired).filter("mark").drop("mark")
    side = lambda x: texts.select(F.col("id").alias(f"id_{x}"), F.col("text").alias(f"text_{x}"))
    return (pairs.join(side("b"), "id_b").join(side("a"), "id_a").select("a", "b", "text_a", "text_b")
            .mapInArrow(_shared(n, lower), "a binary, b binary, shared long, both long")
            .withColumn("linked", F.expr(f"{den} * shared >= {num} * (both - shared)"))
            .select("a", "b", "shared", "linked"))


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def similarity_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                     num: int = 80, den: int = 100, lower: bool = True,
                     sketch_bits: int = SKETCH_BITS) -> tuple[DataFrame, DataFrame]:
    """(rows, links).  rows: id, n_shingles, node for every input row.  links: verified
    pairs a, b of nodes that between them connect every component, with their number of
    shared n-grams."""
    return _linked(docs, id_col, text_col, n, num, den, lower, sketch_bits)[:2]


def _linked(docs: DataFrame, id_col: str, text_col: str, n: int, num: int, den: int, lower: bool,
            sketch_bits: int = SKETCH_BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``similarity_links`` and the components (node, component) of the links."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    first = write_shared(texts.mapInArrow(_first_pass(n, lower, sketch_bits), _FIRST_PASS))
    rows = first.filter("block is null").select("id", "n_shingles", "node")
    nodes = (first.filter("block is null and node is not null and id is not null")
             .groupBy("node").agg(F.min("id").alias("id"), F.min("n_shingles").alias("n_shingles"),
                                  F.first("bands").alias("bands")))
    counts = spark.sparkContext.broadcast(_document_counts(first, sketch_bits))

    prefix = texts.filter("id is not null").mapInArrow(
        _prefixes(n, lower, sketch_bits, num, den, counts), _PREFIX)
    postings = write_shared(prefix.repartition(parallelism(spark), "token", "salt")
                            .sortWithinPartitions("token", "salt", "pos", "size", "node")
                            .mapInArrow(_with_pivot, _POSTINGS))
    nodes = write_shared(nodes.join(postings.select("node").distinct(), "node", "left_semi"))

    star = _overlap_filters(postings.filter("node <> pivot")
                            .withColumnsRenamed({"pivot_pos": "pos_b", "pivot_size": "size_b"}), num, den)
    star = write_shared(_suffix_filter(star.select(*_ordered("node", "pivot")).distinct(), nodes, num, den))
    judged = write_shared(_verify(star, texts, n, lower, num, den))
    member = components(judged.filter("linked"))

    # what is left: lists whose members are in more than one component so far
    placed = postings.select("token", "pos", "size", "node").join(
        member.withColumnRenamed("component", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    split = placed.groupBy("token").agg(F.min("part").alias("x"), F.max("part").alias("y")).filter("x <> y")
    rest = write_shared(placed.join(split.select("token"), "token", "left_semi"))
    other = rest.select("token", F.col("pos").alias("pos_b"), F.col("size").alias("size_b"),
                        F.col("node").alias("node_b"), F.col("part").alias("part_b"))
    pairs = _overlap_filters(rest.join(other, "token").filter("part <> part_b and node < node_b"), num, den)
    pairs = pairs.select(*_ordered("node", "node_b")).distinct().join(judged.select("a", "b"), ["a", "b"], "left_anti")
    more = write_shared(_suffix_filter(pairs, nodes, num, den))
    links = judged.filter("linked")
    if not more.isEmpty():
        found = write_shared(_verify(more, texts, n, lower, num, den)).filter("linked")
        links = links.unionByName(found)
        member = _joined(member, found)
    return rows, links.select("a", "b", "shared"), member


def _joined(member: DataFrame, links: DataFrame) -> DataFrame:
    """The components when ``links`` are added: only the components that a new link joins are
    looked at again; a node without one stands for itself."""
    part = lambda x: member.select(F.col("node").alias(x), F.col("component").alias(f"part_{x}"))
    between = write_shared(links.join(part("a"), "a", "left").join(part("b"), "b", "left")
                           .select(F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b")))
    over = components(between).withColumnsRenamed({"node": "part", "component": "top"})
    alone = over.join(member.select(F.col("component").alias("part")), "part", "left_anti")
    return (member.join(over.withColumnRenamed("part", "component"), "component", "left")
            .select("node", F.coalesce("top", "component").alias("component"))
            .unionByName(alone.select(F.col("part").alias("node"), F.col("top").alias("component"))))


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                       num: int = 80, den: int = 100, lower: bool = True) -> DataFrame:
    """``id_col``, n_shingles, component_id (smallest id reachable by links, itself
    included) and n_copies (rows with the same set) for every input row."""
    rows, _, member = _linked(docs, id_col, text_col, n, num, den, lower)
    per_node = (rows.filter("node is not null and id is not null").groupBy("node")
                .agg(F.min("id").alias("least"), F.count("*").alias("n_copies")))
    grouped = per_node.join(member, "node")
    lowest = grouped.groupBy("component").agg(F.min("least").alias("lowest"))
    linked = grouped.join(lowest, "component").select("node", "lowest")
    classes = per_node.join(linked, "node", "left").select(
        "node", F.coalesce("lowest", "least").alias("component_id"), "n_copies")
    return rows.join(classes, "node", "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.expr("case when node is null or id is null then id else component_id end").alias("component_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"))


def keep_one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents that stay when one of each class of near copies is kept: the smallest
    doc_id.  Repeated rows of a kept document count once; a null doc_id always stays.  Only
    documents whose id is dropped or repeated, and the few that share a mark with one, meet these
    ids, by a shuffle at every size; the others stay where they are.  The input is one struct there, so
    that no name of its columns is in the way."""
    texts = docs.select("doc_id", F.col("text"))
    doubtful = write_shared(
        similarity_classes(texts, n=n, num=num, den=den).filter("doc_id is not null").groupBy(F.col("doc_id").alias("id"))
        .agg(F.max(F.col("doc_id") == F.col("component_id")).alias("kept"), F.count(F.lit(1)).alias("n_rows"))
        .filter("not kept or n_rows > 1").select("id", "kept"))
    rows = with_mark(docs.filter("doc_id is not null").select(
        F.col("doc_id").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), id_marks(doubtful.select("id")))
    dropped = doubtful.filter("not kept").select("id")
    chosen = (rows.filter("mark").select("id", F.xxhash64("row.text").alias("hash"), "row")
              .join(dropped.hint("merge"), "id", "left_anti").dropDuplicates(["id", "hash"]))
    stay = rows.filter("not mark").select("row").unionByName(chosen.select("row"))
    return stay.select(*[F.col("row")[c].alias(c) for c in docs.columns]).unionByName(docs.filter("doc_id is null"))

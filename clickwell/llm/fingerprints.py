"""SimHash document fingerprints (operator 1), in DataFrame functions only.

Every pair of neighbouring words is a term, weighted by its length (at most 15
characters: long words say more than a pair of particles) and by how often it occurs.
Each of the 128 bits of a term's hash votes with the term's weight for or against that
bit of the fingerprint (Charikar 2002).

The votes are ordinary sums.  Bits k and k + 32 of a hash are summed in the two halves
of one long, so 128 vote counters are 64 sums, all in generated code.  A document's
terms are in one task, so map-side aggregation leaves one row per text to shuffle,
whatever the text's length.

``within_radius`` finds all fingerprints within a Hamming radius by permuted block
tables (Manku et al. 2007): the bits are cut into blocks, of which a near pair must
share all but ``radius``; one table per choice of blocks is joined on those bits.

Defined cases: a null or wordless text has the fingerprint 0; equal texts have equal
fingerprints; ties of a vote give 0; null ids come last in descending order; rows that
repeat an id are ordered by their text's hash.  Votes are exact for texts of up to 140
million words.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import write_shared
from .common import let, parallelism
from .quality import words_of

LANES = 0x0000000100000001
LEAST = -(1 << 63)


def terms(text: Column) -> Column:
    """Array of longs: the hash of each word with the next, its weight in the low 4 bits."""
    def term(words):
        def one(word, i):
            following = F.get(words, i + 1)
            weight = F.least(F.length(word) + F.coalesce(F.length(following), F.lit(0)), F.lit(15)).cast("long")
            return F.xxhash64(word, following).bitwiseAND(F.lit(~15)).bitwiseOR(weight)
        return F.transform(words, one)
    return let(words_of(F.coalesce(text, F.lit(""))), term)


def simhash(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` (which name a row), hi and lo: the two halves of the fingerprint."""
    long = texts.select(*keys, F.explode_outer(terms(F.col(text_col))).alias("t"))
    long = long.select(*keys, F.coalesce(F.col("t").bitwiseAND(F.lit(15)), F.lit(0).cast("long")).alias("w"),
                       F.xxhash64("t").alias("hi"), F.xxhash64("t", F.lit(1)).alias("lo"))
    votes = [F.sum(F.expr(f"w * (shiftrightunsigned({h}, {k}) & {LANES}L)")).alias(f"{h}{k}")
             for h in ("hi", "lo") for k in range(32)]
    voted = long.groupBy(*keys).agg(F.sum("w").alias("w"), *votes)

    def half(h: str) -> Column:
        low = [f"(case when 2 * ({h}{k} & 4294967295L) > w then {1 << k}L else 0L end)" for k in range(32)]
        high = [f"(case when 2 * shiftrightunsigned({h}{k}, 32) > w then shiftleft(1L, {k + 32}) else 0L end)"
                for k in range(32)]
        return F.expr(" | ".join(low + high)).alias(h)

    return voted.select(*keys, half("hi"), half("lo"))


def as_hex(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def distance(hi_a: Column, lo_a: Column, hi_b: Column, lo_b: Column) -> Column:
    return (F.bit_count(hi_a.bitwiseXOR(hi_b)) + F.bit_count(lo_a.bitwiseXOR(lo_b))).cast("int")


def likeness(dist: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - dist / F.lit(128.0)


# --- neighbours in descending id order, without a global sort into one task ------------

def bucketed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text and bucket: ranges of ids of about equal size, two per shuffle partition."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = 2 * parallelism(docs.sparkSession)
    cuts = rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 10_000)).first()[0] or []
    below = F.array(*[F.lit(c).cast("long") for c in sorted(set(cuts))]).cast("array<bigint>")
    bucket = F.size(F.filter(below, lambda c: c < F.col("id")))
    return rows.withColumn("bucket", F.when(F.col("id").isNull(), -1).otherwise(bucket))


def _following(rows: DataFrame, heads: DataFrame, values: list[str], order) -> DataFrame:
    """Adds next_<value>: the value of the next row by descending bucket and then
    ``order``, after the last row that of the first.  heads: the first row of each
    bucket, so at most twice as many as shuffle partitions."""
    packed = F.struct(*values)
    down = Window.orderBy(F.desc("bucket"))
    after = heads.select("bucket", packed.alias("v")).select(
        "bucket", F.coalesce(F.lead("v").over(down), F.first("v").over(down)).alias("after"))
    led = rows.withColumn("__lead", F.lead(packed).over(order))
    joined = led.join(after.withColumnRenamed("bucket", "b"),
                      (F.col("bucket") == F.col("b")) & F.col("__lead").isNull(), "left")
    value = F.coalesce("__lead", "after")
    return joined.select(*rows.columns, *[value[v].alias(f"next_{v}") for v in values])


def edited_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: its fingerprint, that of its edited text (the last third of the code
    points replaced by as many from the start of the next document) and the next
    document's.  Columns: id, n_chars, edited_sha256, hi, lo, edited_hi, edited_lo,
    next_hi, next_lo."""
    source = bucketed(docs, id_col, text_col)
    order = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("id"), F.xxhash64("text"))
    rows = source.withColumn("place", F.row_number().over(order))
    # the first row of each bucket: its key from a narrow aggregation, then its text
    key = F.struct(F.coalesce("id", F.lit(LEAST)).alias("id"), F.bitwise_not(F.xxhash64("text")).alias("h"))
    tops = source.groupBy("bucket").agg(F.max(key).alias("top")).select(F.col("bucket").alias("b"), "top")
    heads = (source.join(F.broadcast(tops), (F.col("bucket") == F.col("b")) & (key == F.col("top")))
             .select("bucket", "text").dropDuplicates(["bucket"]))
    chars = F.length("text").cast("long")
    cut = _following(rows, heads, ["text"], order).withColumn("n_chars", chars).withColumn(
        "edited", F.concat(F.expr("substring(text, 1, cast(n_chars as int) - cast(n_chars div 3 as int))"),
                           F.expr("substring(next_text, 1, cast(n_chars div 3 as int))")))
    both = cut.select("bucket", "place", "id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      F.explode(F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("body")),
                                        F.struct(F.lit(1).alias("version"), F.col("edited").alias("body")))).alias("x"))
    keys = ["bucket", "place", "id", "n_chars", "edited_sha256", "version"]
    prints = simhash(both.select(*keys[:-1], "x.*"), keys, "body")
    of = lambda c, v: F.max(F.when(F.col("version") == v, F.col(c)))
    wide = write_shared(prints.groupBy(*keys[:-1]).agg(
        of("hi", 0).alias("hi"), of("lo", 0).alias("lo"), of("hi", 1).alias("edited_hi"), of("lo", 1).alias("edited_lo")))
    return _following(wide, wide.filter("place = 1"), ["hi", "lo"],
                      Window.partitionBy("bucket").orderBy("place")).drop("bucket", "place")


def within_radius(prints: DataFrame, radius: int = 3, blocks: int = 6, id_col: str = "id") -> DataFrame:
    """All pairs of different fingerprints (columns id, hi, lo) within ``radius`` bits:
    a, b (smallest ids of the two fingerprints' rows, a < b) and dist.  Equal
    fingerprints are one class and are not listed as pairs; null ids are left out."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("0 <= radius < blocks <= 64 is needed")
    classes = prints.filter(F.col(id_col).isNotNull()).groupBy("hi", "lo").agg(F.min(id_col).alias("id"))
    edge = [128 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        bits = sum(((1 << edge[i + 1]) - (1 << edge[i])) for i in chosen)
        masks.append([x - (1 << 64) if x >> 63 else x for x in (bits >> 64, bits & ((1 << 64) - 1))])
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(h).cast("long").alias("mh"), F.lit(low).cast("long").alias("ml"))
                       for i, (h, low) in enumerate(masks)])
    keyed = classes.select("id", "hi", "lo", F.explode(tables).alias("x")).select(
        "id", "hi", "lo", F.col("x.t").alias("t"), F.col("hi").bitwiseAND(F.col("x.mh")).alias("kh"),
        F.col("lo").bitwiseAND(F.col("x.ml")).alias("kl"))
    other = keyed.select("t", "kh", "kl", F.col("id").alias("b"), F.col("hi").alias("hi_b"), F.col("lo").alias("lo_b"))
    dist = distance(F.col("hi"), F.col("lo"), F.col("hi_b"), F.col("lo_b"))
    return (keyed.join(other, ["t", "kh", "kl"]).filter("id < b").withColumn("dist", dist)
            .filter(F.col("dist") <= radius).select(F.col("id").alias("a"), "b", "dist").distinct())


def neighbours(docs: DataFrame, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, fingerprint, class_id (smallest id of an equal fingerprint) and n_links (other
    fingerprints within ``radius`` bits) per row; null ids are in no class and have no links.  Rows
    that repeat a text have one fingerprint, which is voted on once."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(
        "id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "text")
    prints = write_shared(simhash(rows.select("digest", "text").dropDuplicates(["digest"]), ["digest"]))
    placed = write_shared(rows.select("id", "digest").join(prints, "digest").select("id", "hi", "lo"))
    pairs = within_radius(placed, radius)
    links = (pairs.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links")))
    classes = placed.filter("id is not null").groupBy("hi", "lo").agg(F.min("id").alias("class_id")).join(links, "class_id", "left")
    keyed = placed.join(classes, ["hi", "lo"], "left")
    member = F.col("id").isNotNull()
    return keyed.select(F.col("id").alias(id_col), as_hex(F.col("hi"), F.col("lo")).alias("fingerprint"),
                        F.when(member, F.col("class_id")).alias("class_id"),
                        F.when(member, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"))

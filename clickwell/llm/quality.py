"""Quality rules as a bitmask ledger (operator 6), in DataFrame functions only.

Every rule is evaluated once per document.  The ledger keeps the measurements and one
bit per failed rule; a policy is a versioned mask of rules, so a changed policy, or the
question what a policy would do without one of its rules, needs no second look at the
texts (``apply_policy``, ``ablations``).

All work on a text happens in its own row, with array functions whose cost is at most
n log n in its words.  Nothing is shuffled to build the ledger.

Defined cases: null text is measured as empty (no words, so ``few_words`` fails); null
ids, repeated rows and ties are judged row by row; other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import let

SPACE = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    fails: str  # SQL over the measurements


RULES = (
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    Rule("repeated_lines", 3, "2 * n_dup_lines > n_lines"),
    Rule("word_length", 4, "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("few_letters", 5, "2 * n_letters < word_chars"),
    Rule("shouting", 6, "2 * n_upper > n_letters"),
)


def mask(*names: str) -> int:
    by_name = {r.name: r.bit for r in RULES}
    return sum(1 << by_name[n] for n in names)


#: versioned policies: a document is kept if none of the policy's rules fails
POLICIES = {
    "base-1": mask("few_words", "repeated_windows"),
    "web-1": mask(*(r.name for r in RULES)),
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_letters", "n_upper")


def words_of(text: Column) -> Column:
    """Array of words (no entry for leading or trailing white space)."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t\\n\\x0B\\f\\r]+"))


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def _repeated(words: Column, width: int = 3) -> Column:
    """Number of words in windows of ``width`` words found twice or more."""
    hashed = F.slice(F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, width)])),
                     1, F.size(words) - (width - 1))

    def places(windows: Column) -> Column:
        placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(placed, lambda p: F.filter(p, lambda e, k: (F.get(p, k - 1)["h"] == e["h"]).eqNullSafe(True)
                                               | (F.get(p, k + 1)["h"] == e["h"]).eqNullSafe(True)))
        return F.sort_array(F.transform(twice, lambda e: e["i"]))

    def covered(at: Column) -> Column:  # each place adds its words up to the next place
        return F.aggregate(F.transform(at, lambda x, k: F.coalesce(F.least(F.lit(width), F.get(at, k + 1) - x),
                                                                   F.lit(width)).cast("long")),
                           F.lit(0).cast("long"), lambda s, x: s + x)

    some = let(hashed, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
               .otherwise(let(places(h), covered)))
    return F.when(F.size(words) < width, F.lit(0).cast("long")).otherwise(some)


def measure(text: Column) -> Column:
    """Struct of all measurements of a text."""
    text = F.coalesce(text, F.lit(""))
    chars = F.length(text).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]"))
    by_word = let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                                     _repeated(w).alias("n_repeat_words")))
    by_line = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return F.struct(by_word.alias("words"), by_line.alias("lines"),
                    _without(text, "[ \\t\\n\\x0B\\f\\r]+").alias("word_chars"),
                    (chars - _without(text, "[#*$%&|<>]+")).alias("n_symbols"),
                    _without(text, "[^\\p{L}]+").alias("n_letters"),
                    _without(text, "[^\\p{Lu}]+").alias("n_upper"))


def with_ledger(docs: DataFrame, text_col: str = "text", name: str = "ledger") -> DataFrame:
    """(row, ``name``): the input in one struct, so that no name of its columns is in the
    way, and the measurements and ``failures``, the bits of the rules that fail.  The
    generator makes sure that a text is measured once, however often the column is used."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    once = docs.select(row, F.inline(F.array(F.struct(measure(F.col(f"`{text_col}`")).alias("measured")))))
    m = F.col("measured")
    values = {"n_words": m["words"]["n_words"], "n_repeat_words": m["words"]["n_repeat_words"],
              "n_lines": m["lines"]["n_lines"], "n_dup_lines": m["lines"]["n_dup_lines"],
              **{c: m[c] for c in ("word_chars", "n_symbols", "n_letters", "n_upper")}}
    measured = F.struct(*[values[c].alias(c) for c in MEASURES])

    def failures() -> Column:
        bits = F.lit(0).cast("long")
        for rule in RULES:
            sql = " ".join(f"x.{t}" if t in MEASURES else t for t in rule.fails.split())
            bits = bits.bitwiseOR(F.expr(f"element_at(transform(array(m), x -> case when {sql} then {1 << rule.bit}L "
                                         "else 0L end), 1)"))
        return bits

    return (once.select("row", measured.alias("m"))
            .select("row", F.struct(*[F.col("m")[c].alias(c) for c in MEASURES], failures().alias("failures")).alias(name)))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the measurements and ``failures`` for every row."""
    return with_ledger(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).select(
        F.col("row.id").alias(id_col), "ledger.*")


def passes(failures: Column, policy: str) -> Column:
    return failures.bitwiseAND(F.lit(POLICIES[policy])) == 0


def apply_policy(ledger_rows: DataFrame, policy: str) -> DataFrame:
    return ledger_rows.withColumn("kept", passes(F.col("failures"), policy))


def keep(docs: DataFrame, policy: str = "web-1") -> DataFrame:
    """The documents that a policy keeps, with their own columns."""
    return with_ledger(docs).filter(passes(F.col("ledger.failures"), policy)).select(
        *[F.col("row")[c].alias(c) for c in docs.columns])


def ablations(ledger_rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that the
    policy would keep without it.  Documents are first counted per failure mask (at most
    2 ** rules rows), so the rules are compared on that small table."""
    chosen = POLICIES[policy]
    masks = (ledger_rows.select(F.col("failures").bitwiseAND(F.lit(chosen)).alias("f"))
             .groupBy("f").agg(F.count("*").alias("n")))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("b"))
                      for r in RULES if chosen >> r.bit & 1])
    per = masks.select("f", "n", F.explode(rules).alias("r")).select("f", "n", "r.rule", "r.b")
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    return per.groupBy("rule").agg(
        F.sum("n").alias("n_docs"),
        count(F.col("f").bitwiseAND(F.col("b")) != 0).alias("n_failed"),
        count(F.col("f") == F.col("b")).alias("n_failed_alone"),
        count(F.col("f").bitwiseAND(F.bitwise_not("b")) == 0).alias("n_kept_without"))

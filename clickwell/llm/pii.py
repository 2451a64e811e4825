"""Personal data in texts (operator 12), in DataFrame functions only.

For every kind of data a regular expression proposes spans, a checksum or another
validator confirms them (Luhn for cards, mod 97 for bank accounts, number ranges for
addresses), and words near the span adjust its score.  Spans of the kinds in ``BASE`` stay
whatever their context; a span of another kind stays if its score reaches ``LEAST_SCORE`` and
it meets no base span.

All work on a text happens in its own row; nothing is shuffled.  Matches and the pieces
between them come from the same expression (``regexp_extract_all``, ``split``), so places
are running sums of their lengths, in code points; the sums are taken block by block, and
no step costs more than n * sqrt(n) in the matches of a text.  The expressions use possessive
quantifiers and start only where a run of characters starts, so a run of any length is
read once; they match what the plain expressions in ``KINDS``'s comments match.

Defined cases: null text counts as empty (no spans); null ids and repeated rows are judged
row by row; other columns are left alone, except that ``find`` adds the column it is
asked for.  Spans of different kinds may overlap; ``redact`` replaces the first of them and
skips spans that begin inside a replaced one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import let

SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string,score:double>>"
LEAST_SCORE = 0.5
#: code points before and after a span that are searched for context words
NEAR = 40
_BLOCK = 64


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the Luhn checksum of a text of digits is right."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(backwards, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d < 5, 2 * d).otherwise(2 * d - 9)
    backwards = F.reverse(digits)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether a bank account number (no blanks) has the remainder 1 by 97."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))
    step = lambda r, c: F.when(c.between("0", "9"), r * 10 + F.ascii(c) - 48).otherwise(
        r * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _parts_in_range(value: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return value.rlike(rf"^{part}(?:\.{part}){{3}}$")


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    gate: str                                # a text without a match of this has no match
    valid: Callable[[Column], Column]        # of the matched text
    score: float
    context: tuple[str, ...] = ()            # lower-case words that raise the score
    raises: float = 0.0
    alone: bool = False                      # no letter or digit may touch the span


def _always(value: Column) -> Column:
    return F.lit(True)


KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
         _always, 0.9, ("mail", "contact", "write"), 0.1),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", _parts_in_range, 0.6,
         ("ip", "address", "host", "server"), 0.3),
    # [0-9]([\x20-]?[0-9])+ of 16 to 19 digits, a maximal chain
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])", "[0-9]",
         lambda v: luhn(_digits(v)), 0.7, ("card", "visa", "credit", "payment"), 0.3),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]",
         lambda v: F.length(_digits(v)).between(8, 15), 0.6, ("phone", "tel", "call", "mobile"), 0.3),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", "[A-Z]{2}[0-9]{2}",
         lambda v: mod97(F.replace(v, F.lit(" "), F.lit(""))), 0.8, ("iban", "account", "bank"), 0.2, alone=True),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "[0-9]-[0-9]",
         lambda v: ~v.rlike("^(?:000|666|9)") & ~v.rlike("-00-") & ~v.rlike("-0000$"), 0.3,
         ("ssn", "social security", "taxpayer"), 0.5, alone=True),
)
BASE = ("email", "ip", "card", "phone")


def running_sums(values: Column) -> Column:
    """Sum of each element and all before it, of an array of longs."""
    zero = F.lit(0).cast("long")
    total = lambda part: F.aggregate(part, zero, lambda a, x: a + x)

    def sums(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int")),
                             lambda b: total(F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK))))
        before = F.aggregate(blocks, F.array(zero), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x)))
        return let(before, lambda s: F.transform(v, lambda x, i: F.get(s, F.floor(i / _BLOCK).cast("int")) + total(
            F.slice(v, i - i % _BLOCK + 1, i % _BLOCK + 1))))

    return let(values, lambda v: F.when(F.size(v) == 0, v).otherwise(sums(v)))


def _score(kind: Kind, before: Column, after: Column) -> Column:
    """Score of a span by the pieces of text before and after it."""
    score = F.lit(kind.score)
    if kind.context:
        near = F.lower(F.concat(F.right(before, F.lit(NEAR)), F.lit(" "), F.left(after, F.lit(NEAR))))
        words = "|".join(kind.context)
        score = score + F.when(near.rlike(f"(?:^|[^a-z])(?:{words})"), F.lit(kind.raises)).otherwise(F.lit(0.0))
    if kind.alone:
        score = F.when(before.rlike("[A-Za-z0-9]$") | after.rlike("^[A-Za-z0-9]"), F.lit(0.0)).otherwise(score)
    return score


def _spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind, in order."""
    pattern, none = F.lit(kind.pattern), F.array().cast(SPAN)

    def placed(found: Column, between: Column) -> Column:
        ends = running_sums(F.transform(found, lambda m, i: (F.length(F.get(between, i)) + F.length(m)).cast("long")))
        spans = let(ends, lambda e: F.transform(found, lambda m, i: F.struct(
            F.lit(kind.name).alias("kind"), (F.get(e, i) - F.length(m)).alias("start"), F.get(e, i).alias("end"),
            m.alias("value"), F.when(kind.valid(m), _score(kind, F.get(between, i), F.get(between, i + 1)))
            .otherwise(F.lit(0.0)).alias("score"))))
        return F.filter(spans, lambda s: s["score"] >= LEAST_SCORE)

    matched = let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: F.when(F.size(found) == 0, none).otherwise(
        let(F.split(text, kind.pattern, -1), lambda between: placed(found, between))))
    return F.when(text.rlike(kind.gate), matched).otherwise(none)


def spans(text: Column) -> Column:
    """All confirmed spans of a text: array of (kind, start, end, value, score), by kind as
    listed in ``KINDS``, then start; places in code points, end exclusive."""
    def found(t: Column) -> Column:
        base = F.concat(*[_spans(t, k) for k in KINDS if k.name in BASE])
        more = F.concat(*[_spans(t, k) for k in KINDS if k.name not in BASE])
        return let(base, lambda b: F.concat(b, F.filter(more, lambda s: ~F.exists(
            b, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"])))))
    return let(F.coalesce(text, F.lit("")), found)


def find(docs: DataFrame, text_col: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` with the spans of their texts.  The generator makes sure that a text is
    searched once, however often the column is used."""
    own = [F.col(f"`{c}`") for c in docs.columns if c != name]
    return docs.select(*own, F.inline(F.array(F.struct(spans(F.col(f"`{text_col}`")).alias(name)))))


def _redacted(text: Column, found: Column) -> Column:
    def add(s: Column, x: Column) -> Column:
        piece = F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))
        return F.when(x["start"] < s["at"], s).otherwise(F.struct(
            x["end"].alias("at"), F.concat(s["parts"], F.array(piece, F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">")))).alias("parts")))
    by_place = F.array_sort(F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    done = F.aggregate(by_place, start, add, lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(
        text, (s["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(found) == 0, text).otherwise(done)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``<KIND>`` in place of every span; null texts stay null."""
    columns = docs.columns
    found = "spans" + "_" * max(len(c) for c in columns)   # no name of the input
    text = F.col(f"`{text_col}`")
    return find(docs, text_col, found).select(*[
        F.when(text.isNotNull(), _redacted(text, F.col(found))).alias(c) if c == text_col else F.col(f"`{c}`")
        for c in columns])


def listed(found: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(found: Column, *kinds: str) -> Column:
    return F.filter(found, lambda s: s["kind"].isin(*kinds))

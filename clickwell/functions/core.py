"""Column-level building blocks.  All are built-in Spark expressions (JVM side,
whole-stage codegen); nothing here runs Python per row."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference ---------------------------------
# Text that a pandas CSV reader turns into a missing value (case-sensitive).
NA_TOKENS = [
    "", "NA", "N/A", "n/a", "<NA>", "#N/A", "#N/A N/A", "#NA", "NULL", "null", "None",
    "nan", "NaN", "-nan", "-NaN", "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN",
]
# What the language's string strip removes.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
              "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# Decimal numbers.  Longer digit strings and exponents of three digits, which could
# overflow a double, are not numbers here.
NUMBER_PATTERN = "^[+-]?([0-9]{1,200}([.][0-9]{0,200})?|[.][0-9]{1,200})([eE][+-]?[0-9]{1,2})?$"
# Trimmed, lower-cased strings that count as an unknown value.
UNKNOWN_STRINGS = ["", "nan", "null", "none", "unknown", "-1"]
# ---------------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_str(v: str) -> str:
    """Spark SQL string literal."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_list(values) -> str:
    return ", ".join(sql_str(v) for v in values)


# Literal-heavy expressions are built as SQL text when the input is a column name:
# the JVM parses the whole expression in one call instead of one call per literal,
# which keeps driver-side plan construction cheap for wide raw tables.
_NA_SQL = _sql_list(NA_TOKENS)
_UNKNOWN_SQL = _sql_list(UNKNOWN_STRINGS)
_SPACE_SQL = sql_str(WHITESPACE)
# first code points of unknown values in either case, of white space, and 0 of empty text
_UNKNOWN_FIRST_SQL = ", ".join(str(x) for x in sorted(
    {0, *map(ord, WHITESPACE)} | {ord(v) for u in UNKNOWN_STRINGS if u for v in (u[0], u[0].upper())}))


def safe_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """n / d as double, 0.0 when d is 0 (bare division by zero raises under ANSI)."""
    n, d = col(numerator), col(denominator)
    return F.when(d == 0, F.lit(0.0)).otherwise(n.cast("double") / d.cast("double"))


def na_to_null(c: str | Column) -> Column:
    """Normalise CSV missing-value tokens to null, as a pandas reader would."""
    if isinstance(c, str):
        q = sql_ident(c)
        return F.expr(f"CASE WHEN {q} IN ({_NA_SQL}) THEN CAST(NULL AS STRING) ELSE {q} END")
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def strip(c: str | Column) -> Column:
    """Text without white space at the ends (all Unicode white space, not only blanks)."""
    return F.btrim(col(c).cast("string"), F.lit(WHITESPACE))


def lenient_double(c: str | Column) -> Column:
    """Parse decimal text as a number; anything else -> null (never raises, never NaN or
    infinite).  A bare cast would also take ``1d``, ``0x1p0`` and ``NAN``.  Plain whole numbers,
    which are most of a log, are told by the text they are written back as; only the rest is
    trimmed and matched."""
    whole, text = col(c).try_cast("bigint"), strip(c)
    return F.when(whole.cast("string") == col(c), whole.cast("double")).when(
        text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def lenient_int(c: str | Column, kind: str = "int") -> Column:
    """Number rounded half to even; unparseable or out of range -> null.  Plain whole numbers in
    range are taken as they are."""
    whole = col(c).try_cast(kind)
    return F.when(whole.cast("string") == col(c), whole).otherwise(F.rint(lenient_double(c)).try_cast(kind))


def is_binary(c: str | Column) -> Column:
    """True for values 0 or 1; null and anything else is False."""
    return F.coalesce(col(c).isin(0, 1), F.lit(False))


def is_unknown_string(c: str | Column) -> Column:
    """Null, or an unknown value once trimmed and lower-cased.  Only text that begins as such a
    value or with white space is trimmed."""
    if isinstance(c, str):
        q = sql_ident(c)
        return F.expr(f"({q} IS NULL OR (ascii({q}) IN ({_UNKNOWN_FIRST_SQL}) AND "
                      f"lower(trim(BOTH {_SPACE_SQL} FROM {q})) IN ({_UNKNOWN_SQL})))")
    return c.isNull() | F.lower(strip(c)).isin(UNKNOWN_STRINGS)


def is_unknown_numeric(c: str | Column) -> Column:
    """Null or numerically -1.  Unparseable non-null text is *not* unknown."""
    c = col(c)
    return c.isNull() | F.coalesce(lenient_double(c) == -1, F.lit(False))


def any_true(columns: list[Column]) -> Column:
    return reduce(or_, columns) if columns else F.lit(False)


def decode_hour_code(c: str | Column) -> Column:
    """``YYMMDDHH`` text -> ``timestamp_ntz`` (wall-clock time, independent of the
    session time zone, so no daylight-saving gap can move an hour); anything else ->
    null.  Two-digit years pivot like C ``strptime``: 69..99 -> 19xx, 00..68 -> 20xx.
    Only exactly eight digits are accepted; impossible dates (month 13, 30 February,
    hour 24) are null."""
    text = strip(c)

    def part(pos: int):
        return F.substring(text, pos, 2).cast("int")

    yy = part(1)
    year = yy + F.when(yy >= 69, F.lit(1900)).otherwise(F.lit(2000))
    return F.when(text.rlike(r"^[0-9]{8}$"),
                  F.try_make_timestamp_ntz(year, part(3), part(5), part(7), F.lit(0), F.lit(0)))


def lookup(c: str | Column, mapping: dict[str, str]) -> Column:
    """Dictionary lookup of a small, configuration-sized map; unmapped -> null."""
    if isinstance(c, str):
        whens = " ".join(f"WHEN {sql_str(k)} THEN {sql_str(v)}" for k, v in mapping.items())
        return F.expr(f"CASE {sql_ident(c)} {whens} ELSE CAST(NULL AS STRING) END")
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), c)

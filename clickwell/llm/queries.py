"""Registered queries of the subpackage: thin contracts over the operators, and their
DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (chat, fingerprints, langid, linededup, mixing, ngram_join, packing, pii, quality, sharding, spelling,
               substring, whitening)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: SQL regular expression of a word, and SQL that lower-cases A-Z only
WORD = r"'[^\x20\x09-\x0D]+'"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op2_ngram_jaccard", f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER}, {WORD}) AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 90 * (x.n + y.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(d, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.d, ways.b FROM reach JOIN ways ON ways.a = reach.r)
SELECT n.doc_id, n.n AS n_shingles, min(r) AS component_id
FROM n JOIN reach ON reach.d = n.doc_id GROUP BY n.doc_id, n.n""")
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(
        table(spark, sf_dir, "documents"), n=3, num=90, den=100).select("doc_id", "n_shingles", "component_id")


@query("op8_substring_dedup", f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) AS ws FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM places),
least AS (SELECT g, min(doc_id) AS m FROM windows GROUP BY g),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM windows JOIN least USING (g) WHERE doc_id > m),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
judged AS (
  SELECT words.doc_id, words.word, words.p, covered.p IS NOT NULL AS gone
  FROM words LEFT JOIN covered ON covered.doc_id = words.doc_id AND covered.p = words.p),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '') AS kept
  FROM judged GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeated(table(spark, sf_dir, "documents"), width=13).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.edited_and_next(table(spark, sf_dir, "documents"))
    near = lambda h, low: fingerprints.likeness(fingerprints.distance(
        F.col("hi"), F.col("lo"), F.col(h), F.col(low)))
    return rows.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        fingerprints.as_hex(F.col("hi"), F.col("lo")).alias("fingerprint"),
        fingerprints.as_hex(F.col("edited_hi"), F.col("edited_lo")).alias("edited_fingerprint"),
        near("edited_hi", "edited_lo").alias("near_edited"), near("next_hi", "next_lo").alias("near_next"))


#: measurements of every document, up to the table m
MEASURES_SQL = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {WORD}) AS ws,
         list_filter(split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {WORD})) AS ls FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g FROM places),
twice AS (SELECT doc_id, g FROM windows GROUP BY doc_id, g HAVING count(*) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM windows JOIN twice USING (doc_id, g)) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS n_letters,
         length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_upper
  FROM w LEFT JOIN repeated r USING (doc_id))"""


@query("op6_quality_rules", f"""{MEASURES_SQL},
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 2 * n_letters < word_chars OR 2 * n_upper > n_letters) AS kept
FROM b""")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    return quality.apply_policy(rows, "web-1").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes(F.col("failures"), "base-1")).alias("base_failed"), "kept")


@query("quality_ablations", f"""{MEASURES_SQL},
f AS (
  SELECT CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
         + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
         + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END
         + CASE WHEN 2 * n_letters < word_chars THEN 32 ELSE 0 END + CASE WHEN 2 * n_upper > n_letters THEN 64 ELSE 0 END AS bits
  FROM m),
rules AS (SELECT unnest(['few_words', 'repeated_windows', 'symbols', 'repeated_lines', 'word_length', 'few_letters', 'shouting']) AS rule,
                 unnest([1, 2, 4, 8, 16, 32, 64]) AS bit)
SELECT rule, count(*) AS n_docs, count(*) FILTER (bits & bit <> 0) AS n_failed, count(*) FILTER (bits = bit) AS n_failed_alone,
       count(*) FILTER (bits & (127 - bit) = 0) AS n_kept_without
FROM rules, f GROUP BY rule""")
def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per rule of the web policy: what it rejects, alone too, and what the policy keeps without it."""
    return quality.ablations(quality.ledger(table(spark, sf_dir, "documents")), "web-1")


@query("simhash_neighbours")
def simhash_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its fingerprint (smallest id) and how many other
    fingerprints lie within three bits."""
    return fingerprints.neighbours(table(spark, sf_dir, "documents"), radius=3)


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op3_language_mixture")
def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", langid.is_held_out(F.col("doc_id")).alias("held_out"), "text", "lang")
    langs, model = langid.train(docs.filter("not held_out"))
    return langid.predict(docs, langs, model, ["doc_id", "held_out"])


@query("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs, most=None, stats="counts", exact_chars=1).select(
        "doc_id", "counts.*", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query("op10_source_mixing")
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = mixing.document_rates(table(spark, sf_dir, "documents"), mixing.label_domains(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
    return rates.select("doc_id", "tokens", "posteriors", "rate", mixing.copies(F.col("rate"), F.col("doc_id")).alias("copies"))


@query("op5_chat_formatting", r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM t),
r AS (
  SELECT conv_id, pos, '<|im_start|>' || replace(role, '<|', '<\|') || chr(10) || replace(text, '<|', '<\|') || '<|im_end|>' || chr(10) AS part
  FROM p),
prefix AS (
  SELECT conv_id, pos, string_agg(part, '') OVER (PARTITION BY conv_id ORDER BY pos) AS body,
         count(*) OVER (PARTITION BY conv_id) AS n FROM r),
whole AS (SELECT conv_id, body, n FROM prefix WHERE pos = n),
firsts AS (SELECT body, n, min(conv_id) AS conv_id, count(*) AS n_logged FROM whole GROUP BY body, n)
SELECT f.conv_id, CAST(f.n AS BIGINT) AS n_turns, f.n_logged, f.body AS rendered
FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM prefix p WHERE p.pos = f.n AND p.n > f.n AND p.body = f.body)""")
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.maximal_conversations(table(spark, sf_dir, "conversations"))


@query("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents").select("doc_id"), sharding.Shards.numbered(64))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(table(spark, sf_dir, "embeddings"), k=16)


def _pii_sql() -> str:
    """The plain expressions of every kind, with the places of matches as running sums."""
    digit = "CAST(substr(reverse(dg), i, 1) AS INTEGER)"
    luhn = (f"list_sum(list_transform(range(1, length(dg) + 1), lambda i: CASE WHEN i % 2 = 1 THEN {digit} "
            f"WHEN {digit} < 5 THEN 2 * {digit} ELSE 2 * {digit} - 9 END)) % 10 = 0")
    bare = "replace(v, ' ', '')"
    mod97 = (f"list_reduce([0] || list_transform(string_split(substr({bare}, 5) || left({bare}, 4), ''), lambda c: ascii(c)), "
             "lambda r, c: CASE WHEN c < 58 THEN r * 10 + c - 48 ELSE r * 100 + c - 55 END % 97) = 1")
    alone = "NOT regexp_matches(b, '[A-Za-z0-9]$') AND NOT regexp_matches(a, '^[A-Za-z0-9]')"
    near = "regexp_matches(lower(right(b, 40) || ' ' || left(a, 40)), '(^|[^a-z])(ssn|social security|taxpayer)')"
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "len(list_filter(string_split(v, '.'), lambda x: CAST(x AS HUGEINT) > 255)) = 0"),
        ("card", r"[0-9]([\x20-]?[0-9])+", f"length(dg) BETWEEN 16 AND 19 AND {luhn}"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(dg) BETWEEN 8 AND 15"),
        ("iban", "[A-Z]{2}[0-9]{2}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})?", f"{alone} AND {mod97}"),
        ("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}",
         f"{alone} AND {near} AND NOT regexp_matches(v, '^(000|666|9)|-00-|-0000$')"))
    ctes = []
    for at, (kind, pattern, valid) in enumerate(kinds):
        ctes.append(f"""m{at} AS (
  SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM d
  WHERE regexp_matches(t, '{pattern}')),
p{at} AS (
  SELECT doc_id, m[i] AS v, g[i] AS b, g[i + 1] AS a, regexp_replace(m[i], '[^0-9]', '', 'g') AS dg,
         sum(length(g[i]) + length(m[i])) OVER (PARTITION BY doc_id ORDER BY i) AS e
  FROM (SELECT doc_id, m, g, unnest(range(1, len(m) + 1)) AS i FROM m{at})),
s{at} AS (
  SELECT doc_id, {at} AS k, '{kind}' AS kind, CAST(e - length(v) AS BIGINT) AS s, CAST(e AS BIGINT) AS e
  FROM p{at} WHERE {valid})""")
    base = " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(4))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{", ".join(ctes)},
base AS ({base}),
more AS (SELECT * FROM s4 UNION ALL SELECT * FROM s5),
kept AS (SELECT * FROM more WHERE NOT EXISTS (
  SELECT 1 FROM base WHERE base.doc_id = more.doc_id AND base.s < more.e AND more.s < base.e)),
every AS (SELECT *, kind || ':' || s || ':' || e AS line FROM (SELECT * FROM base UNION ALL SELECT * FROM kept)),
per AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip, count(*) FILTER (k = 2) AS n_card,
         count(*) FILTER (k = 3) AS n_phone, string_agg(line, ',' ORDER BY k, s) FILTER (k < 4) AS b,
         string_agg(line, ',' ORDER BY k, s) AS a FROM every GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM d LEFT JOIN per USING (doc_id)"""


@query("op12_pii", _pii_sql())
def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")
    number = lambda kind: F.size(pii.of_kind(F.col("spans"), kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[number(k) for k in pii.BASE],
                        F.sha2(pii.listed(pii.of_kind(F.col("spans"), *pii.BASE)), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


@query("op13_spelling_variants", r"""
WITH RECURSIVE
bits(n, c, k) AS (
  SELECT n, n, 0 FROM range(256) t(n)
  UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-z\x{C0}-\x{FF}]+')) AS w FROM documents),
rn AS (SELECT doc_id, w, count(*) AS n, hex(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w) AS hx
       FROM r WHERE length(w) >= 5 GROUP BY doc_id, w),
h AS (
  SELECT w, n, xor(4294967295, list_reduce([4294967295] || list_transform(range(0, length(hx) // 2),
           lambda i: CAST('0x' || substr(hx, 2 * i + 1, 2) AS BIGINT)),
           lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]))) AS h FROM rn, tab),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
cut AS (SELECT word, n, i, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM places),
pairs AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT v.word, cut.word, cut.n FROM cut JOIN v ON v.word = cut.a || cut.b
  UNION SELECT cut.word, v.word, v.n FROM cut JOIN v ON v.word = cut.a || cut.b),
ranked AS (
  SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS k FROM pairs),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form,
         CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN ranked r ON r.word = v.word AND r.k = 1),
chain(word, now) AS (
  SELECT word, word FROM f
  UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.now WHERE f.form IS NOT NULL)
SELECT f.word, f.form, chain.now AS root, f.n, f.n_near, f.form_n
FROM f JOIN chain ON chain.word = f.word JOIN f last ON last.word = chain.now AND last.form IS NULL""")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(spelling.word_counts(table(spark, sf_dir, "documents"))), lead=2)

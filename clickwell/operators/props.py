"""Semi-structured text: JSON properties parsed once, discovered, unnested and profiled.

``parse`` turns a JSON text into a variant (a binary form that knows its types), once per
row; text that is not JSON becomes null and is counted (``quality``).  ``leaves`` unnests
every value to a row (path, type, value), level by level; object keys are
appended to the path as ``.key``, array elements share the path ``[*]``.  Decimal types
are not told apart by their digits.  ``profile`` then counts per path and type.
``discovered_schema`` is the one schema that holds all rows.

Unnesting is narrow (one generator per level, no shuffle).  The profile counts each (path, type,
value) with a map-side part, so a frequent value is one row a task, and then the values per path.

Defined cases: null text is neither malformed nor unnested; a JSON text whose top is not
an object is a leaf or an array of its own (path ``$``); a JSON null is a leaf of type VOID without value;
empty objects and arrays have no leaves; objects nested deeper than ``depth`` come back whole, as one
leaf with their JSON text, so nothing is lost; of a doubled key in one object the text is malformed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DEPTH = 6


def parse(text: str) -> Column:
    return F.try_parse_json(F.col(f"`{text}`"))


def quality(rows: DataFrame, text: str) -> DataFrame:
    """One row: rows, null texts, malformed texts, and well-formed texts by the kind of their top."""
    v = rows.select(F.col(f"`{text}`").alias("t"), parse(text).alias("v"))
    kind = F.schema_of_variant("v")
    return v.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("t").isNull()).alias("n_null"),
                 F.count_if(F.col("t").isNotNull() & F.col("v").isNull()).alias("n_malformed"),
                 F.count_if(kind.startswith("OBJECT")).alias("n_objects"), F.count_if(kind.startswith("ARRAY")).alias("n_arrays"),
                 F.count_if(~kind.startswith("OBJECT") & ~kind.startswith("ARRAY")).alias("n_plain"))


def discovered_schema(rows: DataFrame, text: str) -> DataFrame:
    """One row with the schema (DDL) that every well-formed text fits."""
    return rows.select(F.schema_of_variant_agg(parse(text)).alias("schema"))


def extract(rows: DataFrame, text: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """``rows`` with a typed column per entry of ``fields`` (name to (path, type)); what is absent
    or does not fit the type is null.  The text is parsed once for all of them."""
    parsed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.inline(F.array(F.struct(parse(text).alias("v")))))
    return parsed.select(*[F.col("row")[c].alias(c) for c in rows.columns if c not in fields],
                         *[F.try_variant_get("v", path, kind).alias(name) for name, (path, kind) in fields.items()])


def leaves(rows: DataFrame, text: str, key: str, depth: int = DEPTH) -> DataFrame:
    """(key, path, type, value): one row per leaf of every text; ``value`` is text."""
    spark = rows.sparkSession
    level = rows.select(F.col(f"`{key}`").alias("key"), F.lit("$").alias("path"), parse(text).alias("v")).filter("v is not null")
    out = None
    for step in range(depth + 1):
        kinds = level.select("key", "path", "v", F.schema_of_variant("v").alias("kind"))
        nested = F.col("kind").startswith("OBJECT<") | F.col("kind").startswith("ARRAY<")
        whole = nested if step == depth else F.lit(False)
        done = kinds.filter(~nested | whole).select(
            "key", "path", F.when(nested, F.lit("NESTED")).otherwise(F.regexp_replace("kind", r"\(.*", "")).alias("type"),
            F.when(~F.is_variant_null("v"), F.when(nested, F.to_json("v")).otherwise(F.try_variant_get("v", "$", "string"))).alias("value"))
        out = done if out is None else out.unionByName(done)
        if step == depth:
            break
        inner = kinds.filter(nested).select("key", F.col("path").alias("above"), "v")
        each = inner.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).toDF("pos", "name", "item"))
        level = each.select("key", F.concat("above", F.when(F.col("name").isNull(), F.lit("[*]")).otherwise(
            F.concat(F.lit("."), F.col("name")))).alias("path"), F.col("item").alias("v"))
    return out.withColumnRenamed("key", key)


def profile(rows: DataFrame, text: str, key: str, depth: int = DEPTH) -> DataFrame:
    """Per path and type: number of leaves, distinct values, smallest and largest value (as text)."""
    values = leaves(rows, text, key, depth).groupBy("path", "type", "value").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("path", "type").agg(
        F.sum("n").alias("n_leaves"), F.count("value").alias("n_distinct"), F.min("value").alias("min_value"), F.max("value").alias("max_value"))

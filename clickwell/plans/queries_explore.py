"""Registered queries of sketches, heavy hitters, reconciliation, properties and step paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import heavy, paths, props, reconcile, sketches
from ..operators.clean import clean_ads
from ..session import new_folder, write_shared
from ..sources.adapters import event_props, raw_ads, touches
from .oracle import with_ctes
from .registry import register

# --- sketches that roll up ------------------------------------------------------------------

#: ranges of days that are asked for, as (first, last)
_RANGES = (("2024-01-01", "2024-01-07"), ("2024-01-05", "2024-01-20"), ("2024-01-01", "2024-01-31"), ("2023-01-01", "2023-01-02"))
_RANGES_SQL = ", ".join(f"(DATE '{a}', DATE '{b}')" for a, b in _RANGES)
QUANTILES = (0.1, 0.5, 0.9)


@register("sketch_rollup", f"""WITH r(first_day, last_day) AS (VALUES {_RANGES_SQL}),
j AS (SELECT first_day, last_day, user_id, value FROM r LEFT JOIN events ON CAST(ts AS DATE) BETWEEN first_day AND last_day)
SELECT first_day, last_day, count(user_id) AS n_rows, count(DISTINCT user_id) AS exact_users, true AS users_within_bound,
       true AS quantiles_within_bound
FROM j GROUP BY first_day, last_day""")
def sketch_rollup(spark, sf):
    """Distinct users and value quantiles of day ranges from stored daily sketches, held against
    the exact numbers: whether each estimate keeps its bound."""
    rows = touches(spark, sf).withColumn("day", F.to_date("ts"))
    stored = write_shared(sketches.daily_sketches(rows, "day", ["user_id"], ["value"]))
    ranges = spark.createDataFrame([(a, b) for a, b in _RANGES], "first string, last string").selectExpr(
        "cast(first as date) as first", "cast(last as date) as last")
    told = sketches.roll_up(stored, ranges, ["user_id"], ["value"], QUANTILES)
    # exact: one row per range and day and value would do; the ranges are few, so the log is copied per range
    held = rows.join(F.broadcast(told), F.col("day").between(F.col("first"), F.col("last")))
    q = F.col("value_quantiles")
    ranks = [F.sum(F.when(F.col("value") < q[i], 1).otherwise(0)).alias(f"below{i}") for i in range(len(QUANTILES))] + [
        F.sum(F.when(F.col("value") <= q[i], 1).otherwise(0)).alias(f"upto{i}") for i in range(len(QUANTILES))]
    exact = (held.groupBy("first", "last").agg(F.count(F.lit(1)).alias("n"), *ranks)
             .join(held.select("first", "last", "user_id").distinct().groupBy("first", "last").agg(F.count(F.lit(1)).alias("users")),
                   ["first", "last"]))
    near = F.lit(True)
    for i, p in enumerate(QUANTILES):
        near = near & (F.col(f"below{i}") <= F.col("n") * (p + sketches.RANK_BOUND) + 1) & (
            F.col(f"upto{i}") >= F.col("n") * (p - sketches.RANK_BOUND) - 1)
    return told.join(exact, ["first", "last"], "left").select(
        F.col("first").alias("first_day"), F.col("last").alias("last_day"), "n_rows",
        F.coalesce("users", F.lit(0)).cast("long").alias("exact_users"),
        sketches.distinct_ok(F.col("user_id_distinct"), F.coalesce("users", F.lit(0))).alias("users_within_bound"),
        F.coalesce(near, F.col("n").isNull() & F.col("value_quantiles").isNull()).alias("quantiles_within_bound"))


# --- heavy hitters ---------------------------------------------------------------------------

_HEAVY = ("device_id", "site_id", "app_id", "device_model", "c20")


@register("heavy_hitters", with_ctes(["raw_ads"], "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS count,
        CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INTEGER) AS rank FROM raw_ads WHERE {c} IS NOT NULL GROUP BY {c}"""
    for c in _HEAVY) + ") WHERE rank <= 5"))
def heavy_hitters(spark, sf):
    """The five most frequent values of five columns: few enough values for the summary, or counted in
    full where many values are about equally frequent."""
    return heavy.heavy_hitters(raw_ads(spark, sf), _HEAVY, k=5, counters=256)


# --- reconciliation -----------------------------------------------------------------------------

#: staging rows that are stored twice, thrice, or not at all
_COPIES = "CASE WHEN TRY_CAST(id AS BIGINT) % 97 = 5 THEN 0 WHEN TRY_CAST(id AS BIGINT) % 89 = 6 THEN 2 WHEN TRY_CAST(id AS BIGINT) % 83 = 7 THEN 3 ELSE 1 END"
_STORED = f"stored AS (SELECT stg_ads.* FROM stg_ads, range(3) t(i) WHERE i < {_COPIES})"


def _two_tables(spark, sf):
    """Staging as it follows from the raw log, and as stored, with lost and doubled rows."""
    made = clean_ads(raw_ads(spark, sf))
    path = new_folder(spark, "staging")
    times = F.expr("CASE WHEN try_cast(id AS BIGINT) % 97 = 5 THEN 0 WHEN try_cast(id AS BIGINT) % 89 = 6 THEN 2 "
                   "WHEN try_cast(id AS BIGINT) % 83 = 7 THEN 3 ELSE 1 END")
    (made.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(2)))).filter(F.col("_i") < times).drop("_i")
     .write.parquet(path))
    return made, spark.read.schema(made.schema).parquet(path)


@register("reconcile_differences", with_ctes(["stg_ads"], f"""
SELECT *, 1 AS n_left, CAST({_COPIES} AS BIGINT) AS n_right FROM stg_ads WHERE {_COPIES} <> 1""").replace("1 AS n_left", "CAST(1 AS BIGINT) AS n_left"))
def reconcile_differences(spark, sf):
    """The rows of staging that are lost or doubled in storage, with both counts."""
    return reconcile.differences(*_two_tables(spark, sf))


@register("reconcile_summary", with_ctes(["stg_ads"], f""", {_STORED}
SELECT (SELECT count(*) FROM stg_ads) AS left_rows, (SELECT count(*) FROM stored) AS right_rows,
       (SELECT count(*) FROM (SELECT * FROM stg_ads INTERSECT ALL SELECT * FROM stored)) AS common,
       (SELECT count(*) FROM (SELECT * FROM stg_ads EXCEPT ALL SELECT * FROM stored)) AS only_left,
       (SELECT count(*) FROM (SELECT * FROM stored EXCEPT ALL SELECT * FROM stg_ads)) AS only_right,
       (SELECT count(*) FROM stg_ads WHERE {_COPIES} <> 1) AS distinct_differences"""))
def reconcile_summary(spark, sf):
    return reconcile.summary(*_two_tables(spark, sf))


@register("reconcile_intersect", with_ctes(["stg_ads"], f""", {_STORED}
SELECT * FROM stg_ads INTERSECT ALL SELECT * FROM stored"""))
def reconcile_intersect(spark, sf):
    return reconcile.intersect_all(*_two_tables(spark, sf))


# --- semi-structured properties --------------------------------------------------------------------

_PROPS = """p AS (
  SELECT event_id, CASE
    WHEN event_id % 17 = 3 THEN NULL
    WHEN event_id % 13 = 2 THEN left(props, length(props) - 1)
    WHEN event_id % 19 = 4 THEN '[' || (event_id % 5) || ', "x"]'
    WHEN event_id % 23 = 5 THEN '"only text"'
    WHEN event_id % 11 = 1 THEN '{"k": ' || (event_id % 100) || ', "geo": {"country": "c' || (event_id % 7) || '", "city": null, "at": {"x": '
         || (event_id % 3) || '}}, "tags": ["a' || (event_id % 4) || '", "b"], "ok": true, "score": 1.5}'
    ELSE props END AS props FROM events)"""


@register("props_quality", f"""WITH {_PROPS},
v AS (SELECT props, CASE WHEN json_valid(props) THEN json_type(props) END AS kind FROM p)
SELECT count(*) AS n_rows, count(*) FILTER (props IS NULL) AS n_null, count(*) FILTER (props IS NOT NULL AND kind IS NULL) AS n_malformed,
       count(*) FILTER (kind = 'OBJECT') AS n_objects, count(*) FILTER (kind = 'ARRAY') AS n_arrays,
       count(*) FILTER (kind NOT IN ('OBJECT', 'ARRAY')) AS n_plain FROM v""")
def props_quality(spark, sf):
    return props.quality(event_props(spark, sf), "props")


@register("props_profile", f"""WITH {_PROPS},
l AS (
  SELECT regexp_replace(j.fullkey, '\\[[0-9]+\\]', '[*]', 'g') AS path, j.type AS kind, j.atom ->> '$' AS value
  FROM (SELECT props FROM p WHERE json_valid(props)) q, json_tree(q.props) j)
SELECT path, CASE WHEN kind IN ('UBIGINT', 'BIGINT') THEN 'BIGINT' WHEN kind = 'VARCHAR' THEN 'STRING' WHEN kind = 'DOUBLE' THEN 'DECIMAL'
                  WHEN kind = 'NULL' THEN 'VOID' ELSE kind END AS type,
       count(*) AS n_leaves, count(DISTINCT value) AS n_distinct, min(value) AS min_value, max(value) AS max_value
FROM l WHERE kind NOT IN ('OBJECT', 'ARRAY') GROUP BY 1, 2""")
def props_profile(spark, sf):
    """Every path of the properties with its types and values; malformed texts have none."""
    return props.profile(event_props(spark, sf), "props", "event_id")


@register("props_extract", f"""WITH {_PROPS}
SELECT event_id, CASE WHEN json_valid(props) THEN TRY_CAST(props ->> '$.k' AS BIGINT) END AS k,
       CASE WHEN json_valid(props) THEN props ->> '$.geo.country' END AS country,
       CASE WHEN json_valid(props) THEN props ->> '$.tags[0]' END AS first_tag FROM p""")
def props_extract(spark, sf):
    return props.extract(event_props(spark, sf), "props", {"k": ("$.k", "bigint"), "country": ("$.geo.country", "string"),
                                                           "first_tag": ("$.tags[0]", "string")}).drop("props")


# --- ordered steps ---------------------------------------------------------------------------------

STEPS, PATH_WITHIN = ("view", "click", "purchase"), 5 * 24 * 3600

_ATTEMPTS = f"""RECURSIVE s AS (
  SELECT user_id, epoch_us(ts) AS t, event_type AS kind, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i
  FROM events WHERE event_type IN ('view', 'click', 'purchase')),
walk(user_id, i, times, done) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[][]) FROM s
  UNION ALL
  SELECT user_id, i, CASE WHEN len(now) = 3 THEN [] ELSE now END,
         CASE WHEN len(now) = 3 THEN list_append(before, now) ELSE before END
  FROM (SELECT user_id, i, before, CASE WHEN kind = ['view', 'click', 'purchase'][len(kept) + 1] THEN list_append(kept, t) ELSE kept END AS now
        FROM (SELECT s.user_id, s.i, s.t, s.kind,
                     CASE WHEN len(w.times) > 0 AND s.t - w.times[1] > {PATH_WITHIN * 1_000_000} THEN [] ELSE w.times END AS kept,
                     CASE WHEN len(w.times) > 0 AND s.t - w.times[1] > {PATH_WITHIN * 1_000_000} THEN list_append(w.done, w.times) ELSE w.done END AS before
              FROM walk w JOIN s ON s.user_id = w.user_id AND s.i = w.i + 1))),
fin AS (SELECT user_id, CASE WHEN len(times) > 0 THEN list_append(done, times) ELSE done END AS tries
        FROM walk QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY i DESC) = 1),
attempts AS (SELECT user_id, unnest(tries) AS times, unnest(range(1, len(tries) + 1)) AS attempt FROM fin)"""


@register("step_attempts", f"""WITH {_ATTEMPTS}
SELECT user_id, CAST(attempt AS INTEGER) AS attempt, CAST(len(times) AS INTEGER) AS reached, len(times) = 3 AS complete,
       times[1] AS first_time, times[len(times)] AS last_time FROM attempts""")
def step_attempts(spark, sf):
    """Every user's attempts at view, click, purchase within five days, partial ones too."""
    return paths.match_steps(touches(spark, sf), STEPS, PATH_WITHIN).select(
        "user_id", "attempt", "reached", "complete", F.get("times", F.lit(0)).alias("first_time"),
        F.element_at("times", -1).alias("last_time"))


@register("step_counts", f"""WITH {_ATTEMPTS},
e AS (SELECT unnest(times) AS t, unnest(range(1, len(times) + 1)) AS step, times[1] AS first FROM attempts)
SELECT CAST(step AS INTEGER) AS step, ['view', 'click', 'purchase'][step] AS event_type, count(*) AS n_attempts,
       round(sum(t - first) / count(*) / 1000000, 3) AS mean_seconds FROM e GROUP BY step""")
def step_counts(spark, sf):
    return paths.step_counts(paths.match_steps(touches(spark, sf), STEPS, PATH_WITHIN), STEPS)

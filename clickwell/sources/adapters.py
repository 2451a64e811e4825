"""Adapters from the driver's tables to the two raw inputs the library works on.

* ``raw_ads``: an impression log shaped like the raw ad-click file (all text, as a
  CSV reader with an all-string schema would give), one row per ``events`` row.
  A deterministic share of rows carries the defects the cleaning step must handle:
  invalid click text, undecodable hour codes, missing-value tokens, unknown ids,
  numbers that a plain cast would take (``1d``, ``NAN``) or overflow on, and white space
  other than blanks.
* ``raw_experiment``: one row per ``customer``; the arm comes from the customer key,
  the outcome (visit / conversion / spend) from that customer's orders.

* ``touches`` and ``orders_on_log``: the events as touches of a user, and the orders placed on
  the log's month, ten customers to a user of the log.

The first two are projections of the whole tables, so their work grows with the data: the
ads adapter is a narrow map over ``events``; the experiment adapter pre-aggregates
``orders`` to customer grain (partial aggregation happens map-side, so a customer
holding a third of all orders is reduced before the shuffle) and then left-joins it
to ``customer`` on the key.  Neither side is broadcast: both are customer-grain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ADS_RAW_COLUMNS, EXPERIMENT_RAW_COLUMNS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The projections are written as Spark SQL expressions (``selectExpr``): the JVM
# parses each one in a single call, so building the plan stays cheap even though the
# adapters produce dozens of literal-heavy columns.
_K = "try_cast(regexp_extract(props, '\"k\":\\\\s*(-?[0-9]+)', 1) AS INT)"
_CODE = "date_format(ts, 'yyMMddHH')"

ADS_EXPRS = {
    "id": "CAST(event_id AS STRING)",
    "click": ("CASE WHEN pmod(event_id, 97) = 13 THEN '9' WHEN pmod(event_id, 89) = 7 THEN 'x' "
              "WHEN pmod(event_id, 101) = 9 THEN '1d' WHEN pmod(event_id, 103) = 9 THEN 'NAN' "
              "WHEN pmod(event_id, 107) = 9 THEN concat(char(9), '1.0', char(160)) "
              "WHEN event_type = 'click' THEN '1' ELSE '0' END"),
    "hour": (f"CASE WHEN pmod(event_id, 83) = 5 THEN '99999999' "
             f"WHEN pmod(event_id, 79) = 3 THEN substring({_CODE}, 1, 7) ELSE {_CODE} END"),
    "c1": "'1005'",
    "banner_pos": "CASE WHEN pmod(event_id, 109) = 3 THEN '1e12' ELSE CAST(pmod(event_id, 2) AS STRING) END",
    "site_id": ("CASE pmod(event_id, 53) WHEN 1 THEN '' WHEN 2 THEN ' Unknown ' "
                "WHEN 3 THEN CAST(NULL AS STRING) WHEN 4 THEN '-1' WHEN 5 THEN 'NA' "
                "WHEN 6 THEN concat(char(9), 'unknown', char(12)) "
                f"ELSE concat('site_', CAST(pmod({_K}, 16) AS STRING)) END"),
    "site_domain": f"concat('dom_', CAST(pmod({_K}, 8) AS STRING))",
    "site_category": f"concat('site_', CAST(pmod({_K}, 4) AS STRING))",
    "app_id": "concat('app_id_', CAST(pmod(event_id, 7) AS STRING))",
    "app_domain": "concat('appdom_', CAST(pmod(event_id, 5) AS STRING))",
    "app_category": "concat('app_', CAST(pmod(event_id, 3) AS STRING))",
    "device_id": "concat('dev_', CAST(user_id AS STRING))",
    "device_ip": "concat('ip_', CAST(pmod(user_id, 50) AS STRING))",
    "device_model": "concat('model_', CAST(pmod(user_id, 9) AS STRING))",
    "device_type": ("CASE WHEN pmod(event_id, 61) = 7 THEN '-1' WHEN pmod(event_id, 113) = 7 THEN 'NAN' "
                    "ELSE CAST(pmod(user_id, 4) AS STRING) END"),
    "device_conn_type": ("CASE WHEN pmod(event_id, 127) = 7 THEN '2.5' "
                         "ELSE CAST(pmod(user_id, 3) AS STRING) END"),
    "c14": f"CAST({_K} AS STRING)",
    "c15": "'320'",
    "c16": "'50'",
    "c17": f"CAST({_K} * 10 AS STRING)",
    "c18": "CAST(pmod(user_id, 4) AS STRING)",
    "c19": "'35'",
    "c20": "CAST(pmod(event_id, 100) AS STRING)",
    "c21": "CAST(value AS STRING)",
}


def raw_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type",
                                                "value", "props")
    return ev.selectExpr(*[f"{ADS_EXPRS[c]} AS {c}" for c in ADS_RAW_COLUMNS])


# Raw arm labels of the experiment file (fixed values; see config.SEGMENT_MAP).
ARM_LABELS = ("No E-Mail", "Mens E-Mail", "Womens E-Mail")


def raw_experiment(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    """Customer-grain experiment.  ``variant='contrast'`` gives the arms different
    outcome rules so that one arm wins and one loses significantly."""
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal",
                                                    "c_mktsegment")
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus",
                                                    "o_totalprice", "o_orderpriority")
    urgent = "o_orderpriority = '1-URGENT'"
    if variant == "plain":
        hit = f"({urgent} AND o_orderstatus = 'F')"
    elif variant == "contrast":
        hit = (f"(CASE pmod(o_custkey, 3) WHEN 1 THEN {urgent} AND o_orderstatus IN ('F', 'O') "
               f"WHEN 2 THEN {urgent} AND o_orderstatus = 'F' AND o_totalprice > 200000 "
               f"ELSE {urgent} AND o_orderstatus = 'F' END)")
    else:
        raise ValueError(f"unknown experiment variant {variant!r}")
    zero = "CAST(0 AS DECIMAL(18,2))"
    per_customer = orders.groupBy("o_custkey").agg(
        F.expr(f"max(CASE WHEN {hit} THEN 1 ELSE 0 END)").alias("any_visit"),
        F.expr(f"max(CASE WHEN {hit} AND o_totalprice > 300000 THEN 1 ELSE 0 END)").alias("any_conv"),
        F.expr(f"sum(CASE WHEN {hit} THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE {zero} END)")
        .alias("spend_total"))
    j = cust.join(per_customer, cust.c_custkey == per_customer.o_custkey, "left")
    exprs = {
        "recency": "CAST(pmod(c_custkey, 12) + 1 AS STRING)",
        "history_segment": ("CASE pmod(c_custkey, 3) WHEN 0 THEN '1) $0 - $100' "
                            "WHEN 1 THEN '2) $100 - $200' ELSE '3) $200 - $350' END"),
        "history": "CAST(abs(c_acctbal) AS STRING)",
        "mens": "CAST(pmod(c_custkey, 2) AS STRING)",
        "womens": "CAST(pmod(c_nationkey, 2) AS STRING)",
        "zip_code": ("CASE WHEN pmod(c_custkey, 211) = 5 THEN 'Mars' "
                     "ELSE CASE pmod(c_nationkey, 4) WHEN 0 THEN 'Urban' WHEN 1 THEN 'Suburban' "
                     "WHEN 2 THEN 'Rural' ELSE 'Surburban' END END"),
        "newbie": "CASE WHEN pmod(c_custkey, 5) = 0 THEN '1' ELSE '0' END",
        "channel": ("CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Web' "
                    "WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'Phone' "
                    "WHEN pmod(c_custkey, 127) = 31 THEN 'N/A' ELSE 'Multichannel' END"),
        "segment": (f"CASE WHEN pmod(c_custkey, 107) = 11 THEN 'Both E-Mail' "
                    f"ELSE CASE pmod(c_custkey, 3) WHEN 0 THEN '{ARM_LABELS[0]}' "
                    f"WHEN 1 THEN '{ARM_LABELS[1]}' ELSE '{ARM_LABELS[2]}' END END"),
        "visit": ("CASE WHEN pmod(c_custkey, 103) = 17 THEN '2' "
                  "ELSE CAST(coalesce(any_visit, 0) AS STRING) END"),
        "conversion": ("CASE WHEN pmod(c_custkey, 109) = 19 THEN '1f' "
                       "ELSE CAST(coalesce(any_conv, 0) AS STRING) END"),
        "spend": (f"CASE WHEN pmod(c_custkey, 101) = 23 THEN '-5.0' "
                  f"WHEN pmod(c_custkey, 113) = 29 THEN 'NAN' "
                  f"ELSE CAST(coalesce(spend_total, {zero}) AS STRING) END"),
    }
    return j.selectExpr(*[f"{exprs[c]} AS {c}" for c in EXPERIMENT_RAW_COLUMNS])


def touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, user_id, ts, event_type, value): the whole event log."""
    return _table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")


def orders_on_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, user_id, order_ts, amount): every order, its date folded into the thirty days
    of the log and its second of the day taken from its key."""
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id", "o_custkey div 10 AS user_id",
        "dateadd(SECOND, CAST(pmod(o_orderkey * 7919, 86400) AS INT), dateadd(DAY, CAST(pmod(datediff(o_orderdate, DATE '1995-01-01'), 30) AS INT), "
        "TIMESTAMP_NTZ '2024-01-01 00:00:00')) AS order_ts", "o_totalprice AS amount")


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, ts, kind, id, amount): clicks and orders as rows of one stream."""
    clicks = touches(spark, sf_dir).filter("event_type = 'click'").selectExpr(
        "user_id", "cast(ts as timestamp) as ts", "'click' as kind", "event_id as id", "cast(null as double) as amount")
    return clicks.unionByName(orders_on_log(spark, sf_dir).selectExpr(
        "user_id", "cast(order_ts as timestamp) as ts", "'order' as kind", "order_id as id", "amount"))


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, props): the events' properties; a deterministic share is nested, holds other
    types, is cut short (malformed), is not an object, or is null."""
    return _table(spark, sf_dir, "events").selectExpr("event_id", """CASE
        WHEN pmod(event_id, 17) = 3 THEN CAST(NULL AS STRING)
        WHEN pmod(event_id, 13) = 2 THEN substring(props, 1, length(props) - 1)
        WHEN pmod(event_id, 19) = 4 THEN concat('[', event_id % 5, ', "x"]')
        WHEN pmod(event_id, 23) = 5 THEN '"only text"'
        WHEN pmod(event_id, 11) = 1 THEN concat('{"k": ', event_id % 100, ', "geo": {"country": "c', event_id % 7,
             '", "city": null, "at": {"x": ', event_id % 3, '}}, "tags": ["a', event_id % 4, '", "b"], "ok": true, "score": 1.5}')
        ELSE props END AS props""")

"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Comparison: same row count, same column names, and order-insensitive equal values
(floats compared to 1e-9 relative).  Prints one line per query.
"""
from __future__ import annotations

import math
import sys
import time

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__file__)))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, v)
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, int):
        return (2, float(v))
    return (4, str(v))


STRICT = False


def _eq(a, b) -> bool:
    if a[0] != b[0]:
        return False
    if a[0] == 2:
        x, y = a[1], b[1]
        if STRICT:
            return x == y
        return x == y or abs(x - y) <= 1e-9 * max(1.0, abs(x), abs(y))
    return a == b


SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE",
                 "StringType": "VARCHAR", "DateType": "DATE", "BooleanType": "BOOLEAN",
                 "TimestampType": "TIMESTAMP", "TimestampNTZType": "TIMESTAMP",
                 "ShortType": "SMALLINT", "ByteType": "TINYINT", "FloatType": "FLOAT"}


def type_diff(schema, description):
    def name(t):
        if type(t).__name__ == "ArrayType":
            return name(t.elementType) + "[]"
        return SPARK_TO_DUCK.get(type(t).__name__, type(t).__name__)
    spark_t = {f.name: name(f.dataType) for f in schema.fields}
    duck_t = {d[0]: str(d[1]) for d in description}
    return {c: (spark_t[c], duck_t.get(c)) for c in spark_t if spark_t[c] != duck_t.get(c)}


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: spark={spark_cols} duck={duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return f"rows differ: spark={len(spark_rows)} duck={len(duck_rows)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted(tuple(_norm(r[i]) for i in si) for r in spark_rows)
    b = sorted(tuple(_norm(r[i]) for i in di) for r in duck_rows)
    for ra, rb in zip(a, b):
        if not all(_eq(x, y) for x, y in zip(ra, rb)):
            bad = [order[i] for i, (x, y) in enumerate(zip(ra, rb)) if not _eq(x, y)]
            return f"values differ in {bad}: spark={ra} duck={rb}"
    return None


def main():
    global STRICT
    args = [a for a in sys.argv[1:] if a not in ("--strict", "--plain")
            and not a.startswith("--tz=")]
    STRICT = "--strict" in sys.argv
    tz = next((a.split("=", 1)[1] for a in sys.argv if a.startswith("--tz=")), None)
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    from clickwell.session import local_session
    import __spark_entry__ as E
    if "--plain" in sys.argv:   # a session with Spark's defaults, as a driver may create
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = local_session(cores=__import__("os").environ.get("CORES", "*"))
    if tz:
        spark.conf.set("spark.sql.session.timeZone", tz)
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    failures = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as exc:  # noqa: BLE001
            failures += 1
            print(f"FAIL {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            continue
        dt = time.time() - t0
        if name not in oracle:
            print(f"ROWS {name}: {len(rows)} rows ({dt:.2f}s, no oracle)")
            continue
        try:
            res = con.execute(oracle[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as exc:  # noqa: BLE001
            failures += 1
            print(f"FAIL {name}: duckdb error {str(exc)[:400]}")
            continue
        err = compare(rows, cols, drows, dcols)
        tdiff = type_diff(df.schema, res.description)
        if not err and tdiff:
            err = f"types differ: {tdiff}"
        if err:
            failures += 1
            print(f"FAIL {name}: {err[:600]}")
        else:
            print(f"OK   {name}: {len(rows)} rows ({dt:.2f}s)")
    print(f"failures={failures}")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

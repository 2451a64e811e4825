"""Sessions at once, in parts, and from streams that are restarted and repeat batches."""
import datetime as dt
import random

from pyspark.sql import functions as F

from clickwell.operators import sessions as S
from clickwell.sources.adapters import arrivals
from clickwell.streaming import conversions, sessions as stream

SF = "/root/testdata/sf0.001"
SCHEMA = "user_id long, ts timestamp_ntz, event_type string, value double"
T0 = dt.datetime(2024, 1, 1)


def events(rng, n, users=5, span=20_000):
    return [(rng.choice([0, 0, 0, *range(users)]), T0 + dt.timedelta(minutes=rng.randrange(span)),
             rng.choice(["click", "view"]), rng.randrange(1000) / 100) for _ in range(n)]


def brute(rows, gap):
    out, now = [], {}
    for u, t, k, v in sorted(rows, key=lambda r: (r[0], r[1])):
        s = now.get(u)
        if s and t - s[2] <= dt.timedelta(seconds=gap):
            s[2], s[3], s[4], s[5] = t, s[3] + 1, s[4] + (k == "click"), round(s[5] + v, 2)
        else:
            now[u] = [u, t, t, 1, int(k == "click"), v]
            out.append(now[u])
    return sorted(map(tuple, out))


def rows_of(df):
    return sorted((r.user_id, r.session_start, r.session_end, r.n_events, r.n_clicks, float(r.value)) for r in df.collect())


def test_sessions_equal_brute_force(spark):
    rows = events(random.Random(1), 1500)
    df = spark.createDataFrame(rows + [(None, T0, "click", 1.0), (1, None, "click", 1.0)], SCHEMA)
    for gap in (60, 1800, 86_400):
        assert rows_of(S.sessions(df, gap)) == brute(rows, gap)
    assert S.sessions(df.limit(0), 60).count() == 0


def test_sessions_of_parts_merge_to_the_same(spark):
    rows = events(random.Random(2), 900)
    df = spark.createDataFrame(rows, SCHEMA)
    parts = [S.sessions(df.filter(F.abs(F.hash("ts")) % 3 == k), 1800) for k in range(3)]
    assert rows_of(S.merge(parts[0].unionByName(parts[1]).unionByName(parts[2]), 1800)) == brute(rows, 1800)
    assert rows_of(S.repair(parts[0].unionByName(parts[1]).transform(lambda x: S.merge(x, 1800)), parts[2], 1800)) == brute(rows, 1800)


def run_stream(spark, scratch, parts, gap=1800, delay=3600, base="sessions"):
    for k, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/raw")
        arriving = spark.readStream.schema(SCHEMA).parquet(f"{scratch}/raw")
        stream.start_sessions(arriving, f"{scratch}/{base}", f"{scratch}/ckpt", gap, delay).awaitTermination()


def test_stream_with_late_events(spark, scratch):
    rows = sorted(events(random.Random(3), 600), key=lambda r: r[1])
    late = rows[::17]
    rest = [r for k, r in enumerate(rows) if k % 17]
    parts = [rest[:200], rest[200:400], rest[400:], late]
    run_stream(spark, scratch, parts)
    side = stream.late_events(spark, f"{scratch}/sessions")
    newest = rest[-1][1] - dt.timedelta(hours=1)
    assert side.count() == sum(r[1] < newest for r in late) > 20
    made = stream.closed_sessions(spark, f"{scratch}/sessions").unionByName(stream.open_sessions(spark, f"{scratch}/sessions"))
    assert made.agg(F.sum("n_events")).first()[0] + side.count() == len(rows)    # every event is somewhere, once
    assert rows_of(made) != brute(rows, 1800)
    assert rows_of(stream.reconcile(spark, f"{scratch}/sessions", 1800)) == brute(rows, 1800)


def test_a_repeated_batch_writes_the_same_again(spark, scratch):
    """What a failure after the writes but before the checkpoint's commit leads to."""
    rows = sorted(events(random.Random(4), 300), key=lambda r: r[1])
    step = stream._step(f"{scratch}/s", 1800, 3600)
    batches = [spark.createDataFrame(rows[k::3] if k else rows[:200], SCHEMA) for k in range(3)]
    for k, batch in enumerate(batches):
        step(batch, k)
    once = rows_of(stream.reconcile(spark, f"{scratch}/s", 1800))
    step(batches[2], 2)
    assert rows_of(stream.reconcile(spark, f"{scratch}/s", 1800)) == once


def test_credits_restart_from_the_checkpoint(spark, scratch):
    """Two runs over one checkpoint add up to the batch result for all orders that the watermark
    has passed, and the state keeps nothing of users who are done."""
    rows = arrivals(spark, SF).persist()
    middle = rows.selectExpr("percentile(unix_micros(ts), 0.5) as m").first().m
    newest = rows.selectExpr("max(unix_micros(ts)) as m").first().m
    delay = 3600
    for part in ("<=", ">"):
        rows.filter(f"unix_micros(ts) {part} {middle}").coalesce(2).write.mode("append").parquet(f"{scratch}/raw")
        q = conversions.start_credits(spark.readStream.schema(rows.schema).parquet(f"{scratch}/raw"),
                                      f"{scratch}/out", f"{scratch}/ckpt", 86_400, delay)
        q.awaitTermination()
    got = spark.read.schema(conversions.OUTPUT).parquet(f"{scratch}/out")
    want = conversions.credited_batch(rows, 86_400)
    due = want.filter(f"ts_micros div 1000 < {newest // 1000 - delay * 1000}")
    assert got.exceptAll(due).count() == 0 and due.exceptAll(got).count() == 0
    assert 0 < want.count() - due.count() < 100 and due.filter("n_clicks > 1").count() > 50
    rows.unpersist()


def test_credits_count_clicks_that_come_after_the_order(spark, scratch):
    """The click arrives a batch later than the order it led to, but in time."""
    us = lambda h: T0 + dt.timedelta(hours=h)
    batches = [[(1, us(10), "order", 7, 5.0)], [(1, us(9.5), "click", 1, None), (2, us(9.6), "click", 2, None)],
               [(2, us(40), "click", 3, None)], [(2, us(80), "click", 4, None)]]
    for batch in batches:
        spark.createDataFrame(batch, conversions.INPUT).coalesce(1).write.mode("append").parquet(f"{scratch}/raw")
        arriving = spark.readStream.schema(conversions.INPUT).parquet(f"{scratch}/raw")
        conversions.start_credits(arriving, f"{scratch}/out", f"{scratch}/ckpt", 3600, 7200).awaitTermination()
    rows = spark.read.schema(conversions.OUTPUT).parquet(f"{scratch}/out").collect()
    assert [(r.order_id, r.n_clicks, r.last_click_id) for r in rows] == [(7, 1, 1)]


def test_credits_of_many_users_share_state_and_calls(spark, scratch):
    """Three thousand users cost the state and the calls of the groups they are dealt to, and get what
    brute force gives them, for equal times, repeated and unknown ids and unknown amounts too."""
    rng = random.Random(4)
    at = lambda m: T0 + dt.timedelta(minutes=m)
    rows = [(u, at(rng.randrange(500)), "order", 10 * u, u / 4) for u in range(3000)]
    rows += [(u, at(rng.randrange(400)), "click", u, None) for u in range(0, 3000, 3)]
    hot = [(7, at(5 * rng.randrange(100)), rng.choice(["click", "order"]), rng.choice([None, *range(40)]),
            rng.choice([None, 1.5])) for _ in range(400)]
    rows += [(u, t, k, i, a if k == "order" else None) for u, t, k, i, a in hot]
    for batch in (rows, [(1, at(5000), "click", 0, None)]):
        spark.createDataFrame(batch, conversions.INPUT).coalesce(1).write.mode("append").parquet(f"{scratch}/raw")
        q = conversions.start_credits(spark.readStream.schema(conversions.INPUT).parquet(f"{scratch}/raw"),
                                      f"{scratch}/out", f"{scratch}/ckpt", 3600, 600)
        q.awaitTermination()
        assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) < 6000
    want = []
    for u, t, kind, order, amount in rows:
        if kind == "order":
            near = [(s, -1 if i is None else i) for v, s, k, i, _ in rows
                    if k == "click" and v == u and t - dt.timedelta(hours=1) <= s <= t] if u % 3 == 0 or u == 7 else []
            last = max(near)[1] if near else -1
            want.append((u, order, amount, len(near), None if last < 0 else last))
    got = [(r.user_id, r.order_id, r.amount, r.n_clicks, r.last_click_id)
           for r in spark.read.schema(conversions.OUTPUT).parquet(f"{scratch}/out").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)

from clickwell.plans import inputs
from clickwell.sources.adapters import raw_ads
from clickwell.streaming.incremental import start_hourly_refresh

SF = "/root/testdata/sf0.001"


def test_streaming_hours_match_batch(spark, scratch):
    raw_ads(spark, SF).repartition(3).write.parquet(f"{scratch}/raw")
    q = start_hourly_refresh(spark, f"{scratch}/raw", f"{scratch}/mart", f"{scratch}/ckpt")
    q.awaitTermination(180)
    cols = ["event_date", "event_hour", "impressions", "clicks", "ctr"]
    stream = spark.read.parquet(f"{scratch}/mart").select(*cols)
    batch = inputs.hourly(spark, SF).select(*cols)
    assert stream.count() > 0
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_late_rows_count_in_their_hour(spark, scratch):
    rows = raw_ads(spark, SF).orderBy("hour")
    last = rows.orderBy("hour", ascending=False).limit(200)
    rest = rows.exceptAll(last)
    cols = ["event_date", "event_hour", "impressions", "clicks", "ctr"]
    for part in (last, rest):   # the newest rows come first
        part.coalesce(1).write.mode("append").parquet(f"{scratch}/raw")
        start_hourly_refresh(spark, f"{scratch}/raw", f"{scratch}/mart", f"{scratch}/ckpt").awaitTermination(180)
    stream = spark.read.parquet(f"{scratch}/mart").select(*cols)
    assert stream.exceptAll(inputs.hourly(spark, SF).select(*cols)).count() == 0
    assert stream.count() == inputs.hourly(spark, SF).count()


def test_restart_does_not_duplicate(spark, scratch):
    raw_ads(spark, SF).repartition(2).write.parquet(f"{scratch}/raw")
    for _ in range(2):   # second run resumes from the checkpoint: nothing new to emit
        q = start_hourly_refresh(spark, f"{scratch}/raw", f"{scratch}/mart", f"{scratch}/ckpt")
        q.awaitTermination(180)
    m = spark.read.parquet(f"{scratch}/mart")
    assert m.count() == m.select("event_date", "event_hour").distinct().count()

import gzip
import os

import pytest

from clickwell.schemas import ADS_RAW_TEXT, MART_CAMPAIGN_KPIS
from clickwell.sources import readers, sinks
from tiny_inputs import ADS_HEADER, tiny_ads_rows


def _write_csv(path, header, rows, gz=False):
    lines = [",".join(header)] if header is not None else []
    lines += [",".join("" if v is None else v for v in r) for r in rows]
    text = "\n".join(lines) + "\n"
    opener = gzip.open if gz else open
    with opener(path, "wt") as f:
        f.write(text)


def test_csv_read_and_clean(spark, scratch):
    p = os.path.join(scratch, "ads.csv")
    _write_csv(p, ADS_HEADER, tiny_ads_rows())
    from clickwell.operators.clean import clean_ads
    raw = readers.read_ads_csv(spark, p)
    assert raw.count() == 3 and clean_ads(raw).count() == 2


def test_strict_load_fails_on_bad_value(spark, scratch):
    p = os.path.join(scratch, "ads.csv")
    _write_csv(p, ADS_HEADER, tiny_ads_rows())   # row 3 has click '9' (fine) ...
    assert readers.load_raw_ads(spark, p).count() == 3
    bad = [list(r) for r in tiny_ads_rows()]
    bad[0][1] = "x"
    _write_csv(p, ADS_HEADER, [tuple(r) for r in bad])
    with pytest.raises(Exception):
        readers.load_raw_ads(spark, p).collect()


@pytest.mark.parametrize("with_header", [True, False])
def test_gzip_sample(spark, scratch, with_header):
    p = os.path.join(scratch, "ads.csv.gz")
    _write_csv(p, ADS_HEADER if with_header else None, tiny_ads_rows(), gz=True)
    df = readers.read_gzip_sample(spark, p, 2)
    assert sorted(r.id for r in df.collect()) == ["1001", "1002"]


def test_export_two_zones_and_read_back(spark, scratch):
    import datetime as dt
    mart = spark.createDataFrame([(dt.date(2014, 10, 21), 10, 2, 0.2)], MART_CAMPAIGN_KPIS)
    zones = [os.path.join(scratch, "marts"), os.path.join(scratch, "exports")]
    n = sinks.export_mart(mart, "campaign_kpis.csv", zones, ["event_date"])
    assert n == 1
    back = readers.read_exports(spark, {z: (os.path.join(z, "campaign_kpis.csv"), MART_CAMPAIGN_KPIS)
                                        for z in zones})
    assert [tuple(r) for r in back[zones[0]].collect()] == [tuple(r) for r in back[zones[1]].collect()]
    lines = [[open(os.path.join(z, "campaign_kpis.csv", f)).read() for f in sorted(os.listdir(os.path.join(z, "campaign_kpis.csv")))
              if f.startswith("part-")] for z in zones]
    assert lines[0] and lines[0] == lines[1]
    with pytest.raises(FileNotFoundError):
        readers.read_exports(spark, {"x": (os.path.join(scratch, "nope.csv"), MART_CAMPAIGN_KPIS)})


def test_load_data_audit_stops_at_failure(spark, scratch):
    p = os.path.join(scratch, "ads.csv")
    _write_csv(p, ADS_HEADER, tiny_ads_rows())
    bad = os.path.join(scratch, "bad.csv")
    rows = [list(r) for r in tiny_ads_rows()]
    rows[0][1] = "x"
    _write_csv(bad, ADS_HEADER, rows)
    wh = os.path.join(scratch, "wh")
    targets = [sinks.LoadTarget("raw_avazu_ads", "raw", p, "csv", readers.load_raw_ads),
               sinks.LoadTarget("broken", "raw", bad, "csv", readers.load_raw_ads),
               sinks.LoadTarget("never", "raw", p, "csv", readers.load_raw_ads)]
    spark.range(5).write.parquet(f"{wh}/never")
    audit = sinks.load_data(spark, targets, wh).collect()
    assert [(r.table_name, r.status) for r in audit] == [("raw_avazu_ads", "success"), ("broken", "failed")]
    assert audit[0].row_count == 3 and "CAST_INVALID_INPUT" in audit[1].error
    assert not os.path.exists(f"{wh}/never")   # all targets are cleared before the load
    with pytest.raises(FileNotFoundError, match="nowhere"):
        sinks.load_data(spark, [sinks.LoadTarget("t", "raw", os.path.join(scratch, "nowhere"), "csv", readers.load_raw_ads)], wh)
    assert os.path.exists(f"{wh}/raw_avazu_ads")   # refused before anything is cleared
    with pytest.raises(RuntimeError, match="never"):
        sinks.table_inventory(spark, wh, {"raw_avazu_ads": "raw", "never": "raw"})
    assert sinks.table_inventory(spark, wh, {"raw_avazu_ads": "raw"}).first().row_count == 3


def test_recommendation_matrix_fills_missing(spark):
    df = spark.createDataFrame([("c", "s", "m", "Scale", "e")],
                               "channel string, segment string, metric string, action string, evidence string")
    r = sinks.recommendation_matrix(df).first()
    assert r.caveat is None and list(r.asDict()) == ["channel", "segment", "metric", "action",
                                                     "evidence", "caveat"]


def test_json_summary_round_trip(spark, scratch):
    import datetime as dt
    p = os.path.join(scratch, "summary")
    df = spark.createDataFrame([(1, 0.5, dt.date(2014, 10, 21))], "output_rows long, ctr double, day date")
    sinks.merge_summary(spark, df, "ads", p)
    got = sinks.merge_summary(spark, df.withColumn("output_rows", df.output_rows + 1), "exp", p).first()
    assert (got.dataset, got.output_rows, got.day) == ("exp", 2, dt.date(2014, 10, 21))
    assert sinks.merge_summary(spark, df, "ads", p).count() == 1
    assert readers.read_json_summary(spark, p).count() == 2


def test_csv_columns_are_bound_by_name(spark, scratch):
    p = os.path.join(scratch, "ads.csv")
    swap = [ADS_HEADER.index(c) for c in ("click", "hour")]
    order = list(range(len(ADS_HEADER)))
    order[swap[0]], order[swap[1]] = order[swap[1]], order[swap[0]]
    _write_csv(p, [ADS_HEADER[i].upper() for i in order], [tuple(r[i] for i in order) for r in tiny_ads_rows()])
    assert [(r.click, r.hour) for r in readers.read_ads_csv(spark, p).collect()] == [
        (r[1], r[2]) for r in tiny_ads_rows()]
    _write_csv(p, ADS_HEADER[:-1], [r[:-1] for r in tiny_ads_rows()])
    with pytest.raises(ValueError, match="c21"):
        readers.read_ads_csv(spark, p)


@pytest.mark.parametrize("change", [lambda r: r + ("extra",), lambda r: r[:-1]])
def test_ragged_rows_fail(spark, scratch, change):
    p = os.path.join(scratch, "ads.csv")
    rows = tiny_ads_rows()
    _write_csv(p, ADS_HEADER, [rows[0], change(rows[1]), rows[2]])
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_ads_csv(spark, p).select("id").collect()


def test_import_first_rows_in_file_order(spark, scratch):
    rows = spark.range(1000).selectExpr("cast(id as string) as a", "cast(id * 2 as string) as b").repartitionByRange(7, "a")
    src = os.path.join(scratch, "src")
    rows.write.option("header", True).csv(src)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    whole = [r.a for r in readers.read_raw_csv(spark, src, schema).collect()]
    got = readers.import_csv(spark, src, os.path.join(scratch, "dst"), rows=333, schema=schema)
    assert sorted(r.a for r in got.collect()) == sorted(whole[:333])
    with pytest.raises(Exception):
        readers.import_csv(spark, os.path.join(scratch, "nope"), os.path.join(scratch, "d2"), schema=schema)


def _session(conf, master):
    """A stand-in for a session with the given settings."""
    get = lambda key, default=None: conf.get(key, default)
    core = type("Conf", (), {"get": staticmethod(get)})()
    sc = type("SC", (), {"getConf": lambda self: core, "master": master, "applicationId": "app-" + master})()
    return type("S", (), {"conf": core, "sparkContext": sc})()


def test_checkpoint_dir():
    from clickwell import session
    assert session.checkpoint_dir(_session({"spark.checkpoint.dir": "hdfs:///x/"}, "yarn")) == "hdfs:///x"
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1000]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.checkpoint_dir(_session({}, master))
    a = session.checkpoint_dir(_session({}, "local[4]"))
    assert "clickwell-ckpt-" in a and os.path.isdir(a)


def test_shared_folders_are_removed(spark):
    from clickwell import session
    kept, session._WRITTEN[:] = list(session._WRITTEN), []
    df = session.write_shared(spark.range(5))
    path = df.inputFiles()[0]
    assert df.count() == 5 and session.remove_shared(spark) == 1
    assert not os.path.exists(path.removeprefix("file://"))
    session._WRITTEN[:] = kept

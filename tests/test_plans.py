"""Physical-plan guards for the scale properties the design relies on."""
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _final(df):
    df.write.format("noop").mode("overwrite").save()      # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def _plan(spark, name):
    return _final(E.queries()[name](spark, SF))


@pytest.fixture
def written(monkeypatch):
    """Plans of the tables that segment marts write to the shared folder."""
    from clickwell import session
    from clickwell.operators import kpi
    plans = []

    def record(df):
        plans.append(_final(df))
        return session.write_shared(df)

    monkeypatch.setattr(kpi, "write_shared", record)
    return plans


@pytest.mark.parametrize("name", ["daily_kpis", "hourly_trends", "hourly_range"])
def test_event_log_scanned_once_with_pruning(spark, name):
    plan = _plan(spark, name)
    scans = re.findall(r"FileScan parquet[^\n]*", plan)
    assert len(scans) == 1, plan
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", scans[0]).group(1)
    # never the whole events row: value/props/user_id are read only when needed
    assert "props" not in read_schema or name == "hourly_range"
    if name in ("daily_kpis", "hourly_trends"):
        assert set(f.split(":")[0] for f in read_schema.split(",")) == {"event_id", "ts", "event_type"}


@pytest.mark.parametrize("name", ["daily_kpis", "ab_lift", "profile_top_values", "profile_distinct"])
def test_no_sort_aggregate_and_partial_aggregation(spark, name):
    plan = _plan(spark, name)
    assert "partial_" in plan                        # map-side combine before the shuffle
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "FileScan" in line:
            above = [l for l in lines[:i] if "Aggregate" in l]
            # the first aggregation over the scanned rows is hash-based (sort-based
            # aggregation may only run on already-aggregated rows)
            assert above and "HashAggregate" in above[-1], plan


@pytest.mark.parametrize("name", ["segment_performance", "top_segments", "segment_chart"])
def test_segment_mart_is_built_in_one_scan_and_never_in_one_task(spark, written, name):
    final = _plan(spark, name)
    assert len(written) == 1
    build = written[0]
    assert len(re.findall("FileScan parquet", build)) == 1 and "SinglePartition" not in build
    assert "partial_" in build and "SortAggregate" not in build
    assert "events.parquet" not in final
    lines = final.split("\n")
    for i, line in enumerate(lines):
        if "SinglePartition" in line:   # one partial sum a task, no segment rows
            below = next(x for x in lines[i + 1:] if "Aggregate" in x or "FileScan" in x)
            assert "HashAggregate(keys=[]" in below, final


def test_median_shuffles_counters_only(spark):
    """What a counting pass shuffles does not grow with the rows."""
    from clickwell.operators import profile as P
    for n in (20_000, 200_000):
        values = P._values(spark.range(0, n, 1, 4).selectExpr("cast(hash(id) as double) as x"), "x")
        s = values.selectExpr("min(_x) lo", "max(_x) hi").first()
        width = s.hi / P.BINS - s.lo / P.BINS
        bins = values.selectExpr(f"floor((_x - {s.lo!r}D) / {width!r}D) as b").groupBy("b").count()
        assert bins.count() <= P.BINS + 1
        assert P._value_at(values, n // 2, s.lo, s.hi) == sorted(r[0] for r in values.collect())[n // 2]


def test_validation_reads_each_raw_input_once(spark, monkeypatch):
    """The staging writes are the only plans that touch the raw tables, one scan each."""
    from clickwell.plans import queries_quality as QQ
    from clickwell.sources import sinks
    seen = []
    real = sinks.write_table
    monkeypatch.setattr(sinks, "write_table", lambda df, *a, **k: (seen.append(
        df._jdf.queryExecution().optimizedPlan().toString()), real(df, *a, **k))[1])
    final = _final(QQ.validation_checks(spark, SF))
    assert len(seen) == 2
    for plan in seen:
        for table in ("event_id", "c_custkey", "o_custkey"):
            assert len(re.findall(rf"Relation \[[^\]]*\b{table}#", plan)) <= 1
    for table in ("events", "customer", "orders"):
        assert f"{table}.parquet" not in final

"""Publishing a warehouse: all tables of a load at once, or none."""
import pytest

from clickwell.sources import sinks, versions as V


def target(name, path, reader=lambda s, p: s.read.parquet(p)):
    return sinks.LoadTarget(name, "staging", path, "parquet", reader)


@pytest.fixture
def sources(spark, scratch):
    for k in range(4):
        spark.range(10 * (k + 1)).write.parquet(f"{scratch}/s{k}")
    return lambda k: f"{scratch}/s{k}"


def fails(spark, path):
    return spark.read.parquet(path).selectExpr("raise_error('broken') as id")


def test_a_failed_load_leaves_the_published_version(spark, scratch, sources):
    wh = f"{scratch}/wh"
    with pytest.raises(LookupError):
        V.current(spark, wh)
    audit, first = V.load_data(spark, [target("a", sources(0)), target("b", sources(1)), target("c", sources(2))], wh)
    assert first.number == 1 and [r.row_count for r in audit.collect()] == [10, 20, 30]
    audit, none = V.load_data(spark, [target("a", sources(3)), target("b", sources(3)), target("c", sources(3), fails)], wh)
    assert none is None and [(r.table_name, r.status) for r in audit.collect()] == [("a", "success"), ("b", "success"), ("c", "failed")]
    assert V.current(spark, wh).number == 1
    assert [V.read_table(spark, wh, t).count() for t in "abc"] == [10, 20, 30]
    fs, p = sinks._file_system(spark, f"{wh}/versions")
    assert len(fs.listStatus(p)) == 1                       # nothing of the failed load is left
    with pytest.raises(FileNotFoundError):
        V.load_data(spark, [target("a", f"{scratch}/absent")], wh)


def test_readers_of_a_version_are_not_disturbed(spark, scratch, sources):
    wh = f"{scratch}/wh"
    V.load_data(spark, [target("a", sources(0)), target("b", sources(1))], wh)
    held = V.read_table(spark, wh, "a")
    V.load_data(spark, [target("a", sources(3))], wh)       # b is carried over
    assert held.count() == 10 and V.read_table(spark, wh, "a").count() == 40 and V.read_table(spark, wh, "b").count() == 20
    assert V.read_table(spark, wh, "a", number=1).count() == 10
    with pytest.raises(LookupError):
        V.read_table(spark, wh, "z")


def test_rollback_and_expiry(spark, scratch, sources):
    wh = f"{scratch}/wh"
    for k in range(3):
        V.load_data(spark, [target("a", sources(k)), target("b", sources(0))], wh, keep=3)
    assert V.rollback(spark, wh, 1).number == 4
    assert V.read_table(spark, wh, "a").count() == 10
    assert V.expire(spark, wh, 2) == [1, 2]                 # version 1's folder is still needed by version 4
    assert V.read_table(spark, wh, "a").count() == 10 and V.read_table(spark, wh, "a", 3).count() == 30
    assert [v.number for v in V.history(spark, wh)] == [3, 4] and V.history(spark, wh)[1].source == "rollback to 1"
    with pytest.raises(LookupError):
        V.read_table(spark, wh, "a", 2)
    with pytest.raises(ValueError):
        V.expire(spark, wh, 0)


def test_two_loads_that_race_for_a_number(spark, scratch, sources):
    """The other load commits while this one is writing: this one is told so and publishes nothing."""
    wh = f"{scratch}/wh"
    V.load_data(spark, [target("a", sources(0))], wh)

    def overtaken(s, p):
        if V.current(s, wh).number == 1:
            V.load_data(s, [target("a", sources(2))], wh)
        return s.read.parquet(p)

    with pytest.raises(V.CommitConflict):
        V.load_data(spark, [target("a", sources(1), overtaken)], wh)
    assert V.current(spark, wh).number == 2 and V.read_table(spark, wh, "a").count() == 30
